"""Reading filings and writing results."""

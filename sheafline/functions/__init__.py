"""Column functions: text, vectors and answers."""

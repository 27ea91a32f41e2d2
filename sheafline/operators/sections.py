"""Wide filings to one row per section."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.functions.text import SECTION_PREFIX


def section_columns(filings: DataFrame, prefix: str = SECTION_PREFIX) -> list[str]:
    """Section columns in table order; looks at the schema only."""
    return [name for name in filings.columns if name.startswith(prefix)]


def unpivot_sections(
    filings: DataFrame,
    ids: Sequence[str] = ("cik", "year"),
    *,
    drop_empty: bool = True,
    short_names: bool = False,
    prefix: str = SECTION_PREFIX,
    name_col: str = "section",
    text_col: str = "section_text",
) -> DataFrame:
    """One row per filing and section that has a text.

    NULL sections are dropped; ``drop_empty`` also drops ``''`` (text of blanks is
    always kept). ``short_names`` removes the prefix from the section names, which
    costs nothing at run time because the columns are renamed before the unpivot.
    """
    names = section_columns(filings, prefix)
    if not names:
        raise ValueError(f"no column starts with {prefix!r}")
    shown = {n: n.removeprefix(prefix) if short_names else n for n in names}
    wide = filings.select(*ids, *(F.col(f"`{n}`").cast("string").alias(shown[n]) for n in names))
    long = wide.unpivot(list(ids), [F.col(f"`{s}`") for s in shown.values()], name_col, text_col)
    text = F.col(text_col)
    return long.where(text.isNotNull() & (text != "") if drop_empty else text.isNotNull())

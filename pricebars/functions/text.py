"""Symbol lists and search predicates."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricebars.functions.reference_data import DEFAULT_PROFILES


def symbol_list(text: str | None) -> list[str]:
    """Comma-separated symbols: trimmed, upper-cased, empties dropped; blank means the default list."""
    if text is None or not text.strip():
        return list(DEFAULT_PROFILES)
    return [part.strip().upper() for part in text.split(",") if part.strip()]


def matches(column: Column, text: str, regex: bool = True) -> Column:
    """Case-insensitive contains; NULL counts as no match."""
    if regex:
        hit = column.rlike("(?i)" + text)
    else:
        hit = F.contains(F.lower(column), F.lit(text.lower()))
    return F.coalesce(hit, F.lit(False))

"""Text-to-value cleaning helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_to_double(s: Column) -> Column:
    """``'55%'`` -> 55.0, ``'7'`` -> 7.0, anything else -> NULL."""
    return _try_double(F.replace(s, F.lit("%"), F.lit("")))


def _try_double(s: Column) -> Column:
    return s.try_cast("double")


# plain decimal numbers only (no exponent, no inf/nan words)
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"


def clean_cell(s: Column) -> Column:
    """Table cell: strip white space; ``'-'``, empty or non-numeric -> NULL,
    else the number as a double."""
    stripped = F.regexp_replace(s, r"[\n\r\t ]", "")
    return F.when(stripped.isin("-", ""), F.lit(None).cast("double")).when(
        stripped.rlike(NUMBER_PATTERN), _try_double(stripped)
    )


def split_score(score: Column, default: str = "0-0") -> tuple[Column, Column]:
    """``'2-1'`` -> (2, 1); a NULL score is read as ``default``."""
    parts = F.split(F.coalesce(score, F.lit(default)), "-")
    return parts.getItem(0).cast("int"), parts.getItem(1).cast("int")

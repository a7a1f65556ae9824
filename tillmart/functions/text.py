"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default text and the characters kept in group and list text.
UNKNOWN = "unknown"
GROUP_DROP = r"[^а-яА-ЯёЁa-zA-Z0-9\s-]"
LIST_DROP = r"[^а-яА-ЯёЁa-zA-Z0-9\s,.-]"


def is_blank(value: Column) -> Column:
    """NULL or empty; a value of spaces only is not blank."""
    return F.coalesce(value, F.lit("")) == ""


def tidy(
    value: Column,
    default: str = UNKNOWN,
    lower: bool = True,
    drop: str | None = None,
    strict: bool = False,
) -> Column:
    """Trimmed (and lower-cased) text with a default for missing values.

    The blank test precedes the trim, so ``'   '`` becomes ``''``. With
    ``strict`` such values take the default too.
    """
    cleaned = value if drop is None else F.regexp_replace(value, drop, "")
    cleaned = F.trim(cleaned)
    if lower:
        cleaned = F.lower(cleaned)
    if strict:
        return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(default))
    return F.when(is_blank(value), F.lit(default)).otherwise(cleaned)


def full_name(first: Column, last: Column) -> Column:
    return F.lower(F.concat_ws(" ", tidy(first, lower=False), tidy(last, lower=False)))


def truthy(value: Column) -> Column:
    """1 for true / 1 / yes in any case, else 0."""
    hit = F.lower(F.trim(value)).isin("true", "1", "yes")
    return F.coalesce(hit, F.lit(False)).cast("int")

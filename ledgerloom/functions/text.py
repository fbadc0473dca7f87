"""Cleaning and matching of text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
BARCODE_PATTERN = r"^[0-9]{8,14}\z"  # \z, since Java's $ also matches before a last newline
UNKNOWN_LABEL = "unknown"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def blank_to_null(column: Column | str) -> Column:
    """Trim spaces (no other whitespace) and turn an empty result into NULL."""
    return F.nullif(F.trim(_col(column)), F.lit(""))


def fold(column: Column | str) -> Column:
    return F.lower(_col(column))


def restrict_domain(column: Column | str, domain: Sequence[str]) -> Column:
    """Trimmed lower-case text if it belongs to ``domain``, else NULL."""
    cleaned = F.lower(F.trim(_col(column)))
    return F.when(cleaned.isin(*domain), cleaned)


def first_item(column: Column | str, separator: str = ",") -> Column:
    return F.split_part(_col(column), F.lit(separator), F.lit(1))


def collapse_whitespace(column: Column | str) -> Column:
    return F.regexp_replace(_col(column), r"\s+", " ")


def first_label(column: Column | str) -> Column:
    """First entry of a comma list, whitespace collapsed, NULL if blank."""
    return blank_to_null(collapse_whitespace(first_item(column)))


def label_or_unknown(column: Column | str) -> Column:
    return F.coalesce(first_label(column), F.lit(UNKNOWN_LABEL))


def label_key(column: Column | str) -> Column:
    """Case-insensitive identity of the first label; missing labels share one key."""
    return fold(label_or_unknown(column))


def matches(column: Column | str, pattern: str = BARCODE_PATTERN) -> Column:
    return _col(column).rlike(pattern)


def unit_label(column: Column | str) -> Column:
    """``kJ`` for any spelling of it, other units unchanged."""
    unit = _col(column)
    return F.when(F.lower(unit) == "kj", F.lit("kJ")).otherwise(unit)

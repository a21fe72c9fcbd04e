"""Cleaning rules as column expressions.

Two rule sets are kept apart on purpose: the *preview* rule trims, lower-cases
and treats a token list as missing; the *reporting* rules compare exactly,
untrimmed and case-sensitively.  ``trim`` removes blanks only (not tabs), and
name concatenation yields NULL when either part is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values used by the reference's rules.
REPORT_STORE_STATUS_NULLS = ["N/A", "Unknown", "Off", "0"]
REPORT_GENDER_NULLS = ["N/A", "Unknown", "0"]
PREVIEW_PLACEHOLDERS = ["n/a", "unknown", "null", "0"]
PREVIEW_STORE_NAME_CANDIDATES = ["", " ", "N/A", "0", "Unknown"]
PREVIEW_STORE_STATUS_CANDIDATES = ["N/A", "0"]
SEA_COUNTRIES = ["Singapore", "Malaysia", "Thailand", "Vietnam"]
SEA_PATTERNS = ["%Sing%", "%Malay%", "%Thai%", "%Viet%"]


def trim(c: Column) -> Column:
    return F.trim(c)


def blank_to_null(c: Column) -> Column:
    """``NULLIF(TRIM(c), '')``."""
    return F.nullif(F.trim(c), F.lit(""))


def null_if_in(c: Column, tokens: list[str]) -> Column:
    """``CASE WHEN c IN (tokens) THEN NULL ELSE c END`` (exact match)."""
    return F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c)


def full_name(first: Column, last: Column) -> Column:
    """``first || ' ' || last``: NULL if either is NULL (never concat_ws)."""
    return F.concat(first, F.lit(" "), last)


def is_blank(c: Column) -> Column:
    return F.trim(c) == F.lit("")


def preview_cleaned(c: Column) -> Column:
    t = F.trim(c)
    return (F.when(t == "", F.lit(None).cast("string"))
            .when(F.lower(t).isin(PREVIEW_PLACEHOLDERS), F.lit(None).cast("string"))
            .otherwise(t))


def preview_rule(c: Column) -> Column:
    t = F.trim(c)
    return (F.when(t == "", F.lit("Empty String Rule"))
            .when(F.lower(t).isin(PREVIEW_PLACEHOLDERS), F.lit("Placeholder Rule"))
            .otherwise(F.lit("Valid Data")))

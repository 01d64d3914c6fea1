"""Row-level text functions: filters, word split, alarm messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Static assets are urls ending in ".css" or ".js".
STATIC_ASSET_PATTERN = r"\.(css|js)$"
# Java's \s class (space, tab, newline, vertical tab, form feed, CR).
WHITESPACE_CLASS = "[ \\t\\n\\x0B\\f\\r]"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_static_asset(url: Column | str) -> Column:
    """True for urls whose path ends in .css or .js; ``/a.css?x`` is not one."""
    return _c(url).rlike(STATIC_ASSET_PATTERN)


def exclude_static_assets(df: DataFrame, url: str = "url") -> DataFrame:
    return df.where(~is_static_asset(url))


def equals(df: DataFrame, col: str, value) -> DataFrame:
    """P3 equality filter; pushed to the scan by Catalyst."""
    return df.where(F.col(col) == F.lit(value))


def not_equals(df: DataFrame, col: str, value) -> DataFrame:
    """P4 inequality filter."""
    return df.where(F.col(col) != F.lit(value))


def contains(df: DataFrame, col: str, needle: str) -> DataFrame:
    """P5 substring filter."""
    return df.where(F.col(col).contains(needle))


def split_words(df: DataFrame, text: str = "text", out: str = "word") -> DataFrame:
    """One row per whitespace-separated token; empty tokens dropped."""
    words = F.explode(F.split(F.col(text), WHITESPACE_CLASS))
    return df.select(words.alias(out), *[c for c in df.columns if c != text]).where(
        F.col(out) != ""
    )

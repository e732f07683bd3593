"""Text normalisation of raw CSV columns.

A frame is normalised in two projections, whitespace first and null words second. In
one projection the whitespace rule would be repeated at each of its uses and run
several times per value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milepost.constants import MISSING_TEXT, NULL_TOKENS


def squeeze(text: Column) -> Column:
    """Trimmed text with each run of whitespace as one blank."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def known_or(text: Column, fill: str | None = None) -> Column:
    """``fill`` for empty text and null-like words in any letter case."""
    known = (text != "") & ~F.lower(text).isin(*NULL_TOKENS)
    return F.when(known, text).otherwise(F.lit(fill).cast("string"))


def known_as_written(text: Column) -> Column:
    """NULL for null-like words in exactly their spelling; empty text stays."""
    return F.when(~text.isin(*NULL_TOKENS), text)


def _on_strings(
    df: DataFrame, rules: list[Callable[[Column], Column]], columns: Iterable[str] | None
) -> DataFrame:
    chosen = set(columns) if columns is not None else {
        f.name for f in df.schema if isinstance(f.dataType, T.StringType)
    }
    for rule in rules:
        df = df.select(*[rule(F.col(c)).alias(c) if c in chosen else F.col(c) for c in df.columns])
    return df


def fill_missing_text(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Normalise string columns; unknown values read ``sem dado``."""
    return _on_strings(df, [squeeze, lambda c: known_or(c, MISSING_TEXT)], columns)


def null_missing_text(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Normalise string columns; unknown values become NULL."""
    return _on_strings(df, [squeeze, known_or], columns)


def trim_strings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Trim string columns and drop exact null-like words, keeping inner whitespace."""
    return _on_strings(df, [F.trim, known_as_written], columns)

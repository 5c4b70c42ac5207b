"""Helpers for text columns as they arrive from the landing zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def trimmed(name: str) -> Column:
    """The column without surrounding spaces, under its own name."""
    return F.trim(F.col(name)).alias(name)


def text_or_null(name: str) -> Column:
    """Trimmed text, with blank turned into NULL."""
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def has_text(name: str) -> Column:
    """True where a key column holds something other than blanks."""
    return text_or_null(name).isNotNull()


def folded(name: str) -> Column:
    """Trimmed and lower-cased text."""
    return F.lower(F.trim(F.col(name)))


def whole_number(name: str) -> Column:
    """Text as INT; blank is NULL and anything else that is no integer raises under ANSI."""
    return text_or_null(name).cast("int")


def real_number(name: str) -> Column:
    """Text as DOUBLE; blank is NULL."""
    return text_or_null(name).cast("double")

"""Text functions: tokenizer, UTF-16 length, case maps.  All JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Java's ``\s`` class (no Unicode flag): space, \t, \n, \x0B, \f, \r.
WHITESPACE_RUN = r"\s+"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def word_array(text: str | Column) -> Column:
    """Lower-cased text split on runs of whitespace (may hold empty strings)."""
    return F.split(F.lower(_c(text)), WHITESPACE_RUN)


def tokenize(df: DataFrame, text: str, keep: tuple[str, ...] = (), with_position: bool = False,
             word: str = "word", pos: str = "pos") -> DataFrame:
    """One row per non-empty lower-cased word of ``text`` (flat-map, O-14).

    ``pos`` is the 0-based index in the split array, counted before empty
    tokens are dropped, so it orders words within their line.
    """
    keep_cols = [F.col(k) for k in keep]
    if with_position:
        out = df.select(*keep_cols, F.posexplode(word_array(text)).alias(pos, word))
    else:
        out = df.select(*keep_cols, F.explode(word_array(text)).alias(word))
    return out.filter(F.col(word) != "")


def utf16_length(text: str | Column) -> Column:
    """Length in UTF-16 code units, as Java's ``String.length()`` counts (bigint)."""
    return (F.octet_length(F.encode(_c(text), "UTF-16BE")) / 2).cast("bigint")


def text_length(text: str | Column, unit: str = "utf16") -> Column:
    """``utf16`` (Java semantics) or ``codepoints`` (SQL ``length``), as bigint."""
    if unit == "utf16":
        return utf16_length(text)
    if unit == "codepoints":
        return F.length(_c(text)).cast("bigint")
    raise ValueError(f"unknown unit {unit!r}")


def upper_text(text: str | Column) -> Column:
    return F.upper(_c(text))


def lower_text(text: str | Column) -> Column:
    return F.lower(_c(text))

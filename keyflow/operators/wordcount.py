"""Word counts: bounded totals (O-36) and per-record rolling totals (O-37)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.functions.text import tokenize
from keyflow.operators.scan import running_sums


def word_count(df: DataFrame, text: str = "text", count: str = "cnt") -> DataFrame:
    """(word, cnt) over all lines.  Hot words are combined map-side (partial aggregate)."""
    return tokenize(df, text).groupBy("word").agg(F.count(F.lit(1)).alias(count))


def rolling_word_count(df: DataFrame, text: str, order: Sequence[str], count: str = "cnt",
                       rows_per_chunk: int | None = None) -> DataFrame:
    """One row per word occurrence with the word's running total in arrival order.

    ``order`` names the line's arrival order (e.g. ``conv_id, turn``); the
    word position ``pos`` breaks ties within a line.  Frequent words are split
    into chunks by :func:`running_sums`, so no word lands whole in one task.
    """
    words = tokenize(df, text, keep=tuple(order), with_position=True)
    return running_sums(words, ["word"], [*order, "pos"], {count: F.lit(1)},
                        rows_per_chunk=rows_per_chunk)

"""Adjacent-event patterns per key: ``begin(a).where(p).next(b).where(q).within(t)``.

Strict contiguity: the second event must be the very next event of the key,
so conditions are tested on ``lead`` values computed over *all* events (a
pre-filter would let a non-matching event in between vanish).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.functions.formats import fraud_text
from keyflow.operators.scan import next_in_key

Side = Callable[[str], Column]


def adjacent_pairs(df: DataFrame, key: str, order: Sequence[str], ts: str, cols: Sequence[str],
                   first_where: Callable[[Side], Column], second_where: Callable[[Side], Column],
                   within: str, rows_per_chunk: int | None = None) -> DataFrame:
    """Pairs (first_*, second_*) of consecutive events per key matching both conditions.

    ``within``: the second event's time is strictly less than the first's plus
    this interval.  Every match is kept, overlapping ones included.
    """
    carried = list(dict.fromkeys([*order, ts, *cols]))
    nxt = next_in_key(df.select(key, *carried), [key], order, carried, prefix="_kf_nx_",
                      rows_per_chunk=rows_per_chunk)
    first = lambda c: F.col(c)
    second = lambda c: F.col("_kf_nx_" + c)
    cond = (F.col("_kf_nx_exists") & first_where(first) & second_where(second)
            & (second(ts) < first(ts) + F.expr(f"INTERVAL {within}")))
    return nxt.filter(cond).select(
        F.col(key), *[F.col(c).alias("first_" + c) for c in carried],
        *[F.col("_kf_nx_" + c).alias("second_" + c) for c in carried])


def fraud_pairs(df: DataFrame, card: str = "card", amount: str = "amount",
                location: str = "location", ts: str = "ts", order: Sequence[str] | None = None,
                limit: float = 50.0, within: str = "5 minutes", id_col: str | None = None,
                rows_per_chunk: int | None = None) -> DataFrame:
    """Two consecutive small transactions of a card within ``within`` at different places."""
    order = list(order or [ts])
    cols = [amount, location] + ([id_col] if id_col else [])
    pairs = adjacent_pairs(df, card, order, ts, cols,
                           lambda s: s(amount) < limit, lambda s: s(amount) < limit,
                           within, rows_per_chunk=rows_per_chunk)
    pairs = pairs.filter(F.col("first_" + location) != F.col("second_" + location))
    millis = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    return pairs.withColumn("alert", fraud_text(
        card, "first_" + amount, "first_" + location, millis("first_" + ts),
        "second_" + amount, "second_" + location, millis("second_" + ts)))

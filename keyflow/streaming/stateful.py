"""Keyed state for streams: ``StatefulProcessor``s for ``transformWithState``.

Each processor keeps O(1) or O(distinct items) state per key - never the
key's whole history - and emits one row per input row (or per match).  Rows
of a key inside one micro-batch are ordered explicitly by the ``order``
columns; Spark gives no order within a group.

Two flavours, chosen by group size.  Value-state counters, means and
changelogs see many small groups per micro-batch (one per word, user or
product); they use the Row API (``groupBy(...).transformWithState``), where
a group costs two state calls and no pandas frames - 2.7x faster than the
pandas API on 96k words.  The pair matcher and the item history work on
larger groups with numpy and use ``transformWithStateInPandas``.

These need the RocksDB state store provider
(``spark.sql.streaming.stateStore.providerClass``), set by
:data:`keyflow.session.RECOMMENDED_CONF`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def _concat(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    frames = [f for f in rows if len(f)]
    if not frames:
        return pd.DataFrame()
    return frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)


def _micros(ts: pd.Series) -> np.ndarray:
    return ts.astype("datetime64[us]").astype("int64").to_numpy() if len(ts) else np.array([], "int64")


def _ordered(rows, order: Sequence[str]) -> list[Row]:
    return sorted(rows, key=lambda r: tuple(r[c] for c in order))


def _units(value, scale: int) -> int | None:
    """``value`` in units of 10^-scale, exactly; one with more decimals raises, as in the batch form."""
    if value is None:
        return None
    units = Decimal(str(value)).scaleb(scale)
    if units != units.to_integral_value():
        raise ValueError(f"{value} has more than {scale} decimals")
    return int(units)


class RunningCounter(StatefulProcessor):
    """Per-key counter with default 0 (value state): ``cnt`` after each row.

    Row API (``transformWithState``).  The stream form of the running event
    count, the parity counter and the rolling word count; with ``weight`` it
    adds that column instead of 1 (running pair totals).
    """

    def __init__(self, order: Sequence[str], out_cols: Sequence[str], count: str = "cnt",
                 weight: str | None = None):
        self.order, self.out_cols, self.count, self.weight = list(order), list(out_cols), count, weight

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("count", "c long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        current = self.state.get()
        n = current[0] if current is not None else 0
        for r in _ordered(rows, self.order):
            n += r[self.weight] if self.weight else 1
            yield Row(**{c: r[c] for c in self.out_cols}, **{self.count: n})
        self.state.update((n,))

    def close(self) -> None:
        pass


class RunningMean(StatefulProcessor):
    """Per-key (count, total) value state; emits the running mean after each row.

    Row API.  ``scale`` states the decimals of the input: the total is kept as
    an exact integer number of 10^-scale units, and a value with more decimals
    raises.  As in the batch form a null value counts as a row and adds nothing;
    the mean is null until a value came.
    """

    def __init__(self, order: Sequence[str], out_cols: Sequence[str], value: str, scale: int,
                 average: str = "avg_value"):
        self.order, self.out_cols, self.value = list(order), list(out_cols), value
        self.average, self.scale = average, scale

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("mean", "cnt long, units long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        current = self.state.get()
        cnt, units = (current[0], current[1]) if current is not None else (0, None)
        unit = 10 ** self.scale
        for r in _ordered(rows, self.order):
            cnt += 1
            inc = _units(r[self.value], self.scale)
            if inc is not None:
                units = (units or 0) + inc
            mean = None if units is None else (units / unit) / cnt
            yield Row(**{c: r[c] for c in self.out_cols}, **{self.average: mean})
        self.state.update((cnt, units))

    def close(self) -> None:
        pass


class AdjacentPairMatcher(StatefulProcessor):
    """Strict-next pair matcher per key (the card fraud pattern), value state = last event.

    Keeps the key's latest event; each batch's rows are sorted by
    ``(ts, id)``, rows not after the kept event are late (monotonous
    timestamps) and dropped, and every consecutive pair (kept event included)
    is tested: both amounts ``< limit``, gap ``< within_us``, locations known and different.
    """

    def __init__(self, ts: str = "ts", id_col: str = "event_id", amount: str = "amount",
                 location: str = "location", limit: float = 50.0, within_us: int = 300_000_000,
                 key_col: str = "card"):
        self.ts, self.id, self.amount, self.location = ts, id_col, amount, location
        self.limit, self.within_us, self.key_col = limit, within_us, key_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "ts long, id long, amount double, location string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _concat(rows)
        if pdf.empty:
            return
        pdf = pdf.sort_values([self.ts, self.id], kind="stable")
        ts = _micros(pdf[self.ts])
        ids = pdf[self.id].to_numpy().astype("int64")
        amt = pdf[self.amount].to_numpy().astype("float64")
        loc = pdf[self.location].to_numpy().astype(object)
        loc[~pdf[self.location].notna().to_numpy()] = None
        if self.last.exists():
            lts, lid, lamt, lloc = self.last.get()
            fresh = (ts > lts) | ((ts == lts) & (ids > lid))
            ts, ids, amt, loc = ts[fresh], ids[fresh], amt[fresh], loc[fresh]
            ts = np.concatenate([[lts], ts])
            ids = np.concatenate([[lid], ids])
            amt = np.concatenate([[lamt], amt])
            loc = np.concatenate([np.array([lloc], dtype=object), loc])
        if len(ts) == 0:
            return
        self.last.update((int(ts[-1]), int(ids[-1]), float(amt[-1]), loc[-1]))
        if len(ts) < 2:
            return
        a, b = slice(0, -1), slice(1, None)
        known = np.array([isinstance(x, str) for x in loc])  # a null place differs from nothing
        hit = (known[a] & known[b] & (amt[a] < self.limit) & (amt[b] < self.limit)
               & (ts[b] - ts[a] < self.within_us) & (loc[a] != loc[b]))
        if not hit.any():
            return
        to_ts = lambda us: pd.to_datetime(us, unit="us")
        yield pd.DataFrame({
            self.key_col: np.full(int(hit.sum()), key[0]),
            "first_event_id": ids[a][hit], "first_ts": to_ts(ts[a][hit]),
            "first_amount": amt[a][hit], "first_location": loc[a][hit],
            "second_event_id": ids[b][hit], "second_ts": to_ts(ts[b][hit]),
            "second_amount": amt[b][hit], "second_location": loc[b][hit],
        })

    def close(self) -> None:
        pass


class ItemHistory(StatefulProcessor):
    """Per-user item history as list state.

    For each view of item x, emits one row per other item y in the history with
    ``inc`` = earlier views of y, then adds the view.

    By default the history is exact and unbounded in time: the list holds (item,
    views) entries, a batch appends one entry per item it viewed, and the list is
    merged once it has ``COMPACT`` times as many entries as items, so state follows
    the user's distinct items and not the number of views.  ``cap`` keeps the last
    ``cap`` views only (entries of single views, oldest first), and ``ttl_ms`` forgets
    entries that long after they were written (needs ``timeMode="ProcessingTime"``).

    A batch is worked off in chunks of rows, so that a chunk's cumulative counts
    (rows x items) have at most ``CELLS`` cells, whatever a user's rows or items.
    """

    COMPACT, CELLS = 4, 1 << 20

    def __init__(self, order: Sequence[str], item: str, out_cols: Sequence[str],
                 ttl_ms: int | None = None, cap: int | None = None):
        self.order, self.item, self.out_cols, self.ttl_ms, self.cap = list(order), item, list(out_cols), ttl_ms, cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", "item string, n long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _concat(rows)
        if pdf.empty:
            return
        pdf = pdf.sort_values(self.order, kind="stable").reset_index(drop=True)
        entries = list(self.seen.get()) if self.seen.exists() else []
        items = pdf[self.item].to_numpy().astype(object)
        vocab = np.array(sorted({e[0] for e in entries} | set(items)), dtype=object)
        pos = {v: i for i, v in enumerate(vocab)}
        code = np.array([pos[v] for v in items], dtype=np.int64)
        past = np.array([pos[e[0]] for e in entries], dtype=np.int64)
        if self.cap is None:
            start = np.bincount(past, [e[1] for e in entries], len(vocab)).astype(np.int64)
            gone = np.zeros(0, np.int64)
            self._append(entries, start, code, vocab)
        else:
            views = np.concatenate([past, code])
            start = np.bincount(past, minlength=len(vocab)).astype(np.int64)
            gone = views[:max(0, len(views) - self.cap)]  # the views that drop out, in order
            self.seen.put([(vocab[v], 1) for v in views[len(gone):].tolist()])
        step = max(1, self.CELLS // len(vocab))
        for at in range(0, len(code), step):
            part = code[at:at + step]
            n = np.arange(len(part))
            change = np.zeros((len(part), len(vocab)), dtype=np.int64)
            change[n, part] = 1
            if self.cap is not None:
                # adding row i's view to a full history drops the oldest one
                over = np.arange(at, at + len(part)) + len(entries) - self.cap
                full = over >= 0
                np.add.at(change, (n[full], gone[over[full]]), -1)
            before = start + np.cumsum(change, axis=0) - change
            start = start + change.sum(axis=0)
            before[n, part] = 0                          # never pair an item with itself
            r, c = np.nonzero(before)
            if len(r):
                yield self._rows(pdf, at, r, items[at + r], vocab[c], before[r, c])

    def _append(self, entries: list, start: np.ndarray, code: np.ndarray, vocab: np.ndarray) -> None:
        added = np.bincount(code, minlength=len(vocab))
        new = [(vocab[i], int(added[i])) for i in np.flatnonzero(added)]
        if len(entries) + len(new) > self.COMPACT * len(vocab):
            self.seen.put([(v, int(a + b)) for v, a, b in zip(vocab, start, added, strict=True)])
        else:
            self.seen.appendList(new)

    def _rows(self, pdf: pd.DataFrame, at: int, r: np.ndarray, x: np.ndarray, y: np.ndarray, inc: np.ndarray) -> pd.DataFrame:
        out = pdf[self.out_cols].take(at + r).reset_index(drop=True)
        out[self.item] = x
        out["item_a"] = np.where(x < y, x, y)
        out["item_b"] = np.where(x < y, y, x)
        out["inc"] = inc
        return out

    def close(self) -> None:
        pass


class RetractChangelog(StatefulProcessor):
    """Per-record retract changelog of a keyed running sum (value state = total).

    Row API.  For each row in ``order``: the key's first row emits
    ``+ total``; later rows emit ``- old`` then ``+ new``; a row that leaves
    the total unchanged emits nothing.  Totals are exact integers of
    10^-scale units (a value with more decimals raises); rows without a value emit
    nothing.
    """

    def __init__(self, order: Sequence[str], value: str, out_cols: Sequence[str], scale: int):
        self.order, self.value, self.out_cols, self.scale = list(order), value, list(out_cols), scale

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "units long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        current = self.total.get()
        units = current[0] if current is not None else None
        unit = 10 ** self.scale
        for r in _ordered(rows, self.order):
            inc = _units(r[self.value], self.scale)
            if inc is None:
                continue
            base = {c: r[c] for c in self.out_cols}
            if units is None:
                units = inc
                yield Row(**base, op="+", seq=1, total=units / unit)
            elif inc != 0:
                yield Row(**base, op="-", seq=0, total=units / unit)
                units += inc
                yield Row(**base, op="+", seq=1, total=units / unit)
        if units is not None:
            self.total.update((units,))

    def close(self) -> None:
        pass


class PairDeltas(StatefulProcessor):
    """Change of a user's item-pair co-occurrence in one micro-batch (streaming totals).

    Row API.  Value state: the user's item counts (two arrays).  With count
    vectors n before and n' after the batch, the pair (a, b) gains
    ``n'_a n'_b - n_a n_b`` - exactly the view pairs with at least one new
    view - so totals need no per-view rows.  One row per user and batch
    carries the non-zero deltas as arrays, to be exploded and summed in the
    JVM.
    """

    def __init__(self, item: str, ttl_ms: int | None = None):
        self.item, self.ttl_ms = item, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        # ttl_ms bounds the history in time (needs timeMode="ProcessingTime")
        self.counts = handle.getValueState("counts", "items array<string>, n array<long>", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        current = self.counts.get()
        known = dict(zip(current[0], current[1])) if current is not None else {}
        added: dict = {}
        for r in rows:
            x = r[self.item]
            if x is not None:
                added[x] = added.get(x, 0) + 1
        if not added:
            return
        vocab = sorted(set(known) | set(added))
        before = np.array([known.get(v, 0) for v in vocab], dtype=np.int64)
        after = before + np.array([added.get(v, 0) for v in vocab], dtype=np.int64)
        delta = np.triu(np.outer(after, after) - np.outer(before, before), k=1)
        a, b = np.nonzero(delta)
        self.counts.update((vocab, [int(v) for v in after]))
        if len(a):
            yield Row(item_a=[vocab[i] for i in a], item_b=[vocab[j] for j in b],
                      inc=[int(v) for v in delta[a, b]])

    def close(self) -> None:
        pass


class BucketedPairDeltas(StatefulProcessor):
    """:class:`PairDeltas` of very many users, with state grouped by a hash bucket of the user.

    Keyed by ``pmod(xxhash64(user), buckets)``; one value state per bucket holds its
    users' item counts, so a micro-batch costs a state read and write per bucket, and a
    bucket's deltas leave summed: one row per pair and block of users instead of all
    pairs of every user.  ``user`` is a text column (null: one user); rows without an
    item are ignored.

    A block's counts (users x items) or its users' pairs have at most ``CELLS`` cells,
    whatever the number of users or items; a user with more pairs is worked off in slices.
    """

    CELLS, HELD = 1 << 20, 1 << 20

    def __init__(self, user: str, item: str):
        self.user, self.item = user, item

    def init(self, handle: StatefulProcessorHandle) -> None:
        # cells: (user's place, item's place, count), three longs each, by user and item
        self.counts = handle.getValueState("counts", "users array<string>, items array<string>, cells binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        current = self.counts.get()
        users, items = ({v: i for i, v in enumerate(current[k])} if current is not None else {} for k in (0, 1))
        known = np.frombuffer(bytes(current[2]), np.int64).reshape(-1, 3) if current is not None else np.zeros((0, 3), np.int64)
        held, n = [], 0
        for pdf in rows:
            pdf = pdf[pdf[self.item].notna()]
            if pdf.empty:
                continue
            places = []
            for column, seen in ((self.user, users), (self.item, items)):
                codes, names = pd.factorize(pdf[column], use_na_sentinel=False)
                places.append(np.array([seen.setdefault(v if isinstance(v, str) else None, len(seen)) for v in names], np.int64)[codes])
            held.append(_summed(*places, np.ones((len(pdf), 1), np.int64)))
            n += len(pdf)
            if n >= self.HELD:
                held, n = [_summed(*_stacked(held))], 0
        if not held:
            return
        added = _summed(*_stacked(held))
        both = [(known[:, 0], known[:, 1], known[:, 2:] * [[1, 1]]), (added[0], added[1], added[2] * [[0, 1]])]
        u, i, counts = _summed(*_stacked(both))
        self.counts.update((list(users), list(items), np.column_stack([u, i, counts[:, 1]]).astype(np.int64).tobytes()))
        touched = np.isin(u, added[0])
        names = np.array(list(items), object)
        rank = np.empty(len(names), np.int64)
        rank[np.argsort(names)] = np.arange(len(names))
        names = np.sort(names)
        u, i, counts = u[touched], rank[i[touched]], counts[touched]
        order = np.lexsort((i, u))
        yield from self._deltas(u[order], i[order], counts[order], names)

    def _deltas(self, u: np.ndarray, i: np.ndarray, counts: np.ndarray, names: np.ndarray) -> Iterator[pd.DataFrame]:
        """Summed deltas from the touched users' cells, by user and item, with their counts before and after."""
        first = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
        size = np.diff(np.append(first, len(u)))
        dense = len(names) ** 2 <= self.CELLS and len(size) * len(names) ** 2 <= 8 * int((size ** 2).sum())
        cost = np.full(len(size), len(names)) if dense else size ** 2
        block = (np.cumsum(cost) - cost) // self.CELLS
        for a, b in zip(*(lambda at: (at, np.append(at[1:], len(size))))(np.flatnonzero(np.diff(block, prepend=-1))), strict=True):
            lo, hi = int(first[a]), int(first[b]) if b < len(first) else len(u)
            if dense:
                row = np.repeat(np.arange(b - a), size[a:b])
                delta = np.zeros((len(names), len(names)), np.int64)
                for k, sign in ((0, -1), (1, 1)):
                    matrix = np.zeros((b - a, len(names)), np.int64)
                    matrix[row, i[lo:hi]] = counts[lo:hi, k]
                    delta += sign * (matrix.T @ matrix)
                x, y = np.nonzero(np.triu(delta, k=1))
                yield from self._rows(names, x, y, delta[x, y])
                continue
            # each cell with the later ones of its user, a slice of cells at a time
            later = np.repeat(first[a:b] + size[a:b], size[a:b]) - np.arange(lo, hi) - 1
            cut = (np.cumsum(later) - later) // self.CELLS
            for s, t in zip(*(lambda at: (at, np.append(at[1:], len(later))))(np.flatnonzero(np.diff(cut, prepend=-1))), strict=True):
                left = np.repeat(np.arange(lo + s, lo + t), later[s:t])
                start = np.cumsum(later[s:t]) - later[s:t]
                right = left + 1 + np.arange(len(left)) - np.repeat(start, later[s:t])
                gain = counts[left, 1] * counts[right, 1] - counts[left, 0] * counts[right, 0]
                x, y, inc = _summed(i[left], i[right], gain[:, None])
                yield from self._rows(names, x, y, inc[:, 0])

    def _rows(self, names: np.ndarray, x: np.ndarray, y: np.ndarray, inc: np.ndarray) -> Iterator[pd.DataFrame]:
        some = inc != 0
        if some.any():
            yield pd.DataFrame({"item_a": names[x[some]], "item_b": names[y[some]], "inc": inc[some]})

    def close(self) -> None:
        pass


def _stacked(parts: list) -> tuple:
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _summed(a: np.ndarray, b: np.ndarray, counts: np.ndarray) -> tuple:
    """Different (a, b) in order, and the sums of their counts (a row each)."""
    if not len(a):
        return a, b, counts
    order = np.lexsort((b, a))
    a, b, counts = a[order], b[order], counts[order]
    start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return a[start], b[start], np.add.reduceat(counts, start)


class BucketedRunningCounter(StatefulProcessor):
    """Running count per key with state grouped by a hash bucket of the key.

    For streams with very many small keys (words): the operator is keyed by
    ``pmod(xxhash64(key), buckets)`` and one value state per bucket holds the
    counts of its keys as two arrays, so a micro-batch costs one state read
    and write per bucket instead of per key, and counting is numpy.  Rows are
    ordered by ``order`` inside the batch.

    A bucket's state grows with its distinct keys.  To go on with another number of
    buckets, start a new query with :func:`carried_counts` as its initial state.
    """

    def __init__(self, key: str, order: Sequence[str], out_cols: Sequence[str],
                 key_type: str = "string", count: str = "cnt"):
        self.key, self.order, self.out_cols = key, list(order), list(out_cols)
        self.key_type, self.count = key_type, count

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("counts", f"keys array<{self.key_type}>, n array<long>")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        current = self.state.get()
        known = dict(zip(current[0], current[1])) if current is not None else {}
        for word, n in zip(initialState[self.key].tolist(), initialState["n"].tolist(), strict=True):
            known[word] = known.get(word, 0) + int(n)
        self.state.update((list(known.keys()), list(known.values())))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _concat(rows)
        if pdf.empty:
            return
        pdf = pdf.sort_values(self.order, kind="stable").reset_index(drop=True)
        current = self.state.get()
        known = dict(zip(current[0], current[1])) if current is not None else {}
        codes, uniques = pd.factorize(pdf[self.key], use_na_sentinel=False)
        start = np.array([known.get(u, 0) for u in uniques], dtype=np.int64)
        within = pdf.groupby(codes, sort=False).cumcount().to_numpy(dtype=np.int64) + 1
        counts = start[codes] + within
        added = np.bincount(codes, minlength=len(uniques)).astype(np.int64)
        for u, total in zip(uniques, start + added):
            known[u] = int(total)
        self.state.update((list(known.keys()), list(known.values())))
        out = pdf[self.out_cols].copy()
        out[self.count] = counts
        yield out

    def close(self) -> None:
        pass


def carried_counts(spark: SparkSession, checkpoint: str, key: str, buckets: int) -> DataFrame:
    """(_bucket, key, n): a stopped :class:`BucketedRunningCounter` query's state, dealt into ``buckets`` buckets.

    The initial state of a changed query (``transformWithStateInPandas(...,
    initialState=carried.groupBy("_bucket"))``) with a checkpoint of its own, whose
    input begins where the stopped one's ended.
    """
    state = spark.read.format("statestore").option("stateVarName", "counts").load(checkpoint)
    words = state.select(F.explode(F.arrays_zip("value.keys", "value.n")).alias("w"))
    words = words.select(F.col("w.keys").alias(key), F.col("w.n").alias("n"))
    return words.select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket"), key, "n")

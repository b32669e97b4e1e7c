"""N-gram Jaccard join with PartEnum signatures (operator 2).

Equal shingle sets form one class, identified by a 64-bit hash of the set (two
different sets agree with a probability of about 2**-64, as do two shingles).

1. One pass over the texts gives (doc_id, set size, class) and the classes'
   signatures (:mod:`keyflow.llm.partenum`).  A task meets each class once, and
   of the classes in one task that share a signature it sends one on and lists
   the group, so a signature that a third of all rows share reaches its bucket
   once per task.  Signatures travel packed, in buckets by hash.
2. A signature met twice gives a group.  Neighbours within a group are compared
   exactly on their sets; similar ones are linked, links give components.
3. Groups whose members lie in several components are compared further, groups
   with the same members once: cells of member blocks name the pairs of different
   components that sizes and parity sketches (exact bounds) allow, at most so many
   per member and cell.  They are compared exactly; rounds go on, with a higher
   number, in the groups where a member had further pairs.  So no link between
   components is lost, and members already connected are never paired.

Sizes and sketches also sort out neighbours before sets are fetched.

The result has one row per document.

Defined cases: a null or text without words has an empty set, linked with
nothing (its component is its own id); a text of one to four words has one
shingle, the whole sequence; repeated rows and equal texts share a component;
a null id takes part and never becomes a component's name unless all ids of the
component are null; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import marked_in, saved, table, tidy, utf8
from keyflow.llm.components import components
from keyflow.llm.partenum import signatures
from keyflow.llm.shingles import Sketch, parity_sketch, set_key, shingle_sets, sketch_difference
from keyflow.llm.wordhash import mix

NUM, DEN, WIDTH = 75, 100, 5
#: Text bytes for each bucket of signatures, and signatures that a task holds before it sends them.
BUCKET_BYTES, FLUSH = 8_000_000, 1_000_000
#: Members of one block in step 3, and pairs that a member asks for per block and round.
CELL_ROWS, ASKS = 512, 64
#: Pairs that a task of step 3 remembers, so as not to name them again.
PAIRS_HELD = 500_000
#: Copies of a component's name that its classes are dealt to.
SALTS = 16

_PACKED = ("bucket long, kind int, sigs binary, keys binary, counts binary, ids array<long>, sizes array<long>, "
           "sketches array<binary>")
_GROUPS = "kind int, sig long, keys array<long>, ids array<long>, sizes array<long>, sketches array<binary>"
MEMBERS, LOCAL, SENT, WHOLE = 0, 1, 2, 3


def _pack(bucket: int, kind: int, sigs=b"", keys=b"", counts=b"", ids=(), sizes=(),
          sketches=()) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int64()), pa.array([kind], pa.int32()), *[pa.array([x], pa.binary()) for x in
         (sigs, keys, counts)], pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
         pa.array([sketches], pa.list_(pa.binary()))],
        ["bucket", "kind", "sigs", "keys", "counts", "ids", "sizes", "sketches"])


def _send(sigs: list[np.ndarray], keys: list[int], buckets: int) -> Iterator[pa.RecordBatch]:
    """One task's signatures: shared ones listed, one class for each signature packed by bucket."""
    sig = np.concatenate(sigs)
    key = np.repeat(np.array(keys, np.int64), [len(s) for s in sigs])
    order = np.lexsort((key, sig))
    sig, key = sig[order], key[order]
    fresh = np.concatenate([[True], (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])])
    sig, key = sig[fresh], key[fresh]
    starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    n = np.diff(np.append(starts, len(sig)))
    several = np.flatnonzero(n > 1)
    for i in range(0, len(several), 20_000):
        some = several[i:i + 20_000]
        lists = np.concatenate([np.arange(starts[j], starts[j] + n[j]) for j in some])
        at = int(mix(sig[starts[some[:1]]])[0] % np.uint64(buckets))
        yield _pack(at, LOCAL, sig[starts[some]].tobytes(), key[lists].tobytes(), n[some].astype(np.int64).tobytes())
    sig, key, shared = sig[starts], key[starts], n > 1
    bucket = _bucket(sig, buckets)
    order = np.lexsort((key, bucket))  # by bucket, and by class within: a class is named once
    sig, key, shared, bucket = sig[order], key[order], shared[order], bucket[order]
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        some = slice(edges[b], edges[b + 1])
        s, k = sig[some], key[some]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        short = ((s & np.uint64(0x7FFFFFFFFF)) << np.uint64(1)) | shared[some].astype(np.uint64)
        packed = short.view(np.uint8).reshape(-1, 8)[:, :5]  # 39 bits of the signature besides its bucket, and a mark
        yield _pack(int(b), SENT, packed.tobytes(), k[first].tobytes(),
                    np.diff(np.append(first, len(k))).astype(np.int32).tobytes())


def _bucket(sig: np.ndarray, buckets: int) -> np.ndarray:
    return ((sig >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _signed(buckets: int, width: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        sigs: list[np.ndarray] = []
        keys: list[int] = []
        held = 0
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            ids, sizes, names, sketches = batch.column(0).to_pylist(), [], [], []
            for elements in shingle_sets(utf8(batch.column(1)), width):
                sizes.append(len(elements))
                names.append(set_key(elements) if len(elements) else 0)
                sketches.append(None)
                if len(elements) and names[-1] not in known:
                    known.add(names[-1])
                    sketches[-1] = parity_sketch(elements)
                    mine = signatures(elements, num, den)
                    if len(mine):
                        sigs.append(mine)
                        keys.append(names[-1])
                        held += len(mine)
            if ids:
                # dealt by task and batch: equal texts do not meet in one bucket
                at = int(mix(np.array([(task << 32) + number], np.uint64))[0] % np.uint64(buckets))
                yield _pack(at, MEMBERS, keys=np.array(names, np.int64).tobytes(),
                            ids=ids, sizes=sizes, sketches=sketches)
            if held >= FLUSH:
                yield from _send(sigs, keys, buckets)
                sigs, keys, held = [], [], 0
        if held:
            yield from _send(sigs, keys, buckets)
    return run


def _name(sig: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """The group's number: 39 bits of the signature and its bucket."""
    short = np.asarray(sig & np.uint64(0x7FFFFFFFFF)).astype(np.int64)
    return short * 1_000_003 + bucket


def _grouped(key: tuple, rows: pa.Table, buckets: int) -> pa.Table:
    """A bucket's groups: signatures that several tasks sent, besides what tasks listed themselves."""
    bucket = key[0].as_py()
    out: dict[str, list] = {c: [] for c in ("kind", "sig", "keys", "ids", "sizes", "sketches")}

    def add(kind, sig, keys, ids=(), sizes=(), sketches=()):
        for c, v in zip(out, (kind, sig, keys, ids, sizes, sketches), strict=True):
            out[c].append(v)

    sig, owner = [], []
    for kind, sigs, keys, counts, ids, sizes, sketches in zip(
            *(rows.column(c).to_pylist() for c in ("kind", "sigs", "keys", "counts", "ids", "sizes", "sketches")),
            strict=True):
        names = np.frombuffer(keys, np.int64)
        if kind == MEMBERS:
            add(MEMBERS, 0, names.tolist(), ids, sizes, sketches)
        elif kind == LOCAL:
            cuts = np.concatenate([[0], np.cumsum(np.frombuffer(counts, np.int64))]).tolist()
            full = np.frombuffer(sigs, np.uint64)
            for s, a, b in zip(_name(full, _bucket(full, buckets)).tolist(), cuts[:-1], cuts[1:], strict=True):
                add(LOCAL, s, names[a:b].tolist())
        else:
            wide = np.zeros((len(sigs) // 5, 8), np.uint8)
            wide[:, :5] = np.frombuffer(sigs, np.uint8).reshape(-1, 5)
            sig.append(wide.reshape(-1).view(np.uint64))
            owner.append(np.repeat(names, np.frombuffer(counts, np.int32)))
    if sig:
        sig, owner = np.concatenate(sig), np.concatenate(owner)
        short, shared = sig >> np.uint64(1), (sig & np.uint64(1)).astype(bool)
        order = np.lexsort((owner, short))
        short, owner, shared = short[order], owner[order], shared[order]
        fresh = np.concatenate([[True], (short[1:] != short[:-1]) | (owner[1:] != owner[:-1])])
        starts = np.flatnonzero(np.concatenate([[True], short[1:] != short[:-1]]))
        marked = np.logical_or.reduceat(shared, starts)
        ends = np.append(starts[1:], len(short))
        n = np.add.reduceat(fresh.astype(np.int64), starts)
        alone: set[tuple] = set()
        for j in np.flatnonzero(n > 1):
            some = slice(starts[j], ends[j])
            members = owner[some][fresh[some]].tolist()
            if not marked[j]:  # complete as it is: groups with the same members count once
                if tuple(members) in alone:
                    continue
                alone.add(tuple(members))
            add(SENT if marked[j] else WHOLE, int(_name(short[j], bucket)), members)
    kinds = {"kind": pa.int32(), "sig": pa.int64(), **{c: pa.list_(pa.int64()) for c in ("keys", "ids", "sizes")},
             "sketches": pa.list_(pa.binary())}
    return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})


def _collected(docs: DataFrame, buckets: int, width: int, num: int, den: int) -> DataFrame:
    """Members and groups of all texts (``docs``: doc_id, text), written once."""
    def grouped(key, rows):
        return _grouped(key, rows, buckets)

    packed = docs.mapInArrow(tidy(_signed(buckets, width, num, den)), _PACKED)
    return saved(packed.groupBy("bucket").applyInArrow(grouped, _GROUPS), "groups")


def _class_sets(docs: DataFrame, wanted: DataFrame, width: int, num_bits: int = 28) -> DataFrame:
    """(key, elements) of the classes in ``wanted`` (key, doc_id of one member).

    A bit table of bounded size, made of the wanted ids, spares most other texts
    the shingling; the exact join on the class follows.
    """
    n = wanted.count()
    bits = 1 << min(num_bits, max(16, (16 * n).bit_length()))

    def place(column: str):
        return F.when(F.col(column).isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(column), F.lit(bits)).cast("int"))

    marked = wanted.select(place("doc_id").alias("at")).filter("at >= 0")
    words = (marked.groupBy(F.shiftright("at", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, at & 63))").alias("mask")).toPandas())
    table_ = np.zeros(bits >> 6, np.uint64)
    table_[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64).view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(table_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            hit = shared.value[np.maximum(at, 0) >> 6] >> (np.maximum(at, 0) & 63).astype(np.uint64) & np.uint64(1)
            some = np.flatnonzero((at < 0) | (hit > 0))
            sets_ = [s for s in shingle_sets(utf8(batch.column(0).take(pa.array(some))), width) if len(s)]
            if sets_:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_key(s) for s in sets_], pa.int64()),
                     pa.array([s.tobytes() for s in sets_], pa.binary())], ["key", "elements"])

    sets = docs.select("text", place("doc_id").alias("at")).mapInArrow(tidy(run), "key long, elements binary")
    return saved(sets.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"]), "class-sets")


def _allowed(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that the sizes and the sketches of ``classes`` (key, n, sketch) allow to be similar."""
    def side(c: str) -> DataFrame:
        return classes.select(F.col("key").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"of_{c}"))

    both = (pairs.join(side("a"), "a").join(side("b"), "b")
                 .filter(den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b"))
                 .select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), "of_a", "of_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [sketch_difference(x, y) <= (den - num) * n // (den + num) for n, x, y in
                    zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    return both.mapInArrow(tidy(run), "a long, b long")


def _compared(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The similar ones among ``pairs`` (a, b), by their whole sets."""
    left = sets.select(F.col("key").alias("a"), F.col("elements").alias("of_a"))
    right = sets.select(F.col("key").alias("b"), F.col("elements").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                merged = np.sort(np.concatenate([x, y]))
                common = int((merged[1:] == merged[:-1]).sum())
                keep.append(den * common >= num * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    return both.mapInArrow(tidy(run), "a long, b long")


def _open_groups(groups: DataFrame) -> DataFrame:
    """(sig, key) of groups of three and more classes; in smaller ones all pairs are neighbours.

    Groups with the same members count once, whatever signatures they come from:
    two hashes over the members and their number tell them apart.
    """
    whole = groups.filter((F.col("kind") == WHOLE) & (F.size("keys") > 2)).select("sig", F.explode("keys").alias("key"))
    parts = groups.filter(F.col("kind") != WHOLE)  # what single tasks met, and what they sent of it
    rows = whole.unionAll(parts.select("sig", F.explode("keys").alias("key")).distinct())
    named = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), *[
        F.expr(f"bit_xor(xxhash64(key, {i}))").alias(f"x{i}") for i in (1, 2)])
    once = named.filter("n > 2").groupBy("n", "x1", "x2").agg(F.min("sig").alias("sig")).select("sig")
    return saved(rows.join(once, "sig", "left_semi"), "open")


def _further(groups: DataFrame, labels: DataFrame, classes: DataFrame, asks: int, num: int, den: int) -> DataFrame:
    """(a, b): pairs of different components within a group that sizes and sketches allow, written once.

    A member names ``asks`` of them per cell at most; rows (sig) without a pair
    tell the groups in which a member had further ones.  All pairs of any other
    group have been named, so only those groups need to be asked again.
    """
    rows = (groups.join(labels.withColumnRenamed("node", "key"), "key", "left")
                  .withColumn("component", F.coalesce("component", "key")))
    # a group is open if its members lie in several components; whatever lies outside the largest one asks the others,
    # so each pair of different components has an asking side and the bulk of a group that is linked already is quiet
    counted = rows.groupBy("sig", "component").agg(F.count(F.lit(1)).alias("n"), F.min(F.xxhash64("key")).alias("lead"))
    state = counted.groupBy("sig").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("members"), F.min("lead").alias("lead"))
    # groups that overlap mostly have the same least member (by hash) and so meet in a task, which names a pair once;
    # cells are powers of two, for their classes to be dealt alike in groups of about one size
    cells = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("members") / CELL_ROWS)))).cast("int")
    open_ = state.filter("main.n < members").select("sig", "lead", F.col("main.component").alias("main"), cells.alias("cells"))
    placed = rows.join(open_, "sig").join(classes, "key").withColumns({
        "home": F.pmod(F.xxhash64("key"), "cells").cast("int"), "asks": F.col("component") != F.col("main")})
    spread = placed.withColumn("cell", F.explode(
        F.when(F.col("asks"), F.sequence(F.lit(0), F.col("cells") - 1)).otherwise(F.array("home"))))
    full = spread.select("sig", "cell", "key", "component", "n", "sketch", (F.col("home") == F.col("cell")).alias("here"),
                         "asks", "lead")

    def pairs_of(cell: list[tuple], named: set[tuple[int, int]], sent: set[tuple[int, int]]) -> bool:
        """Adds the cell's pairs to ``named``; tells whether a member had more than ``asks``."""
        here = sorted((r for r in cell if r[4]), key=lambda r: r[2])
        sizes = [r[2] for r in here]
        more = False
        for key, component, n, sketch, _, asking in cell:
            if not asking:
                continue
            found = 0
            for other, other_component, m, other_sketch, _, _ in here[bisect_left(sizes, -(-num * n // den)):
                                                                      bisect_right(sizes, n * den // num)]:
                if component == other_component:
                    continue
                pair = (key, other) if key < other else (other, key)
                if pair in named or pair in sent:
                    continue
                if sketch.difference(other_sketch) <= (den - num) * (n + m) // (den + num):
                    if found == asks:
                        more = True
                        break
                    named.add(pair)
                    found += 1
        return more

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cell = None, []
        known: dict[int, Sketch] = {}  # a class lies in many groups
        named: set[tuple[int, int]] = set()  # and a pair too: a task names it once, as long as the set holds it
        sent: set[tuple[int, int]] = set()

        def rows_of(pairs, sigs) -> pa.RecordBatch:
            a, b = ([p[i] for p in pairs] + [None] * len(sigs) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, [None] * len(pairs) + sigs)], ["a", "b", "sig"])

        for batch in batches:
            again: list[int] = []
            sketches = batch.column(5)
            for row, (sig, where, key, component, n, here, asking) in enumerate(
                    zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3, 4, 6, 7)), strict=True)):
                if (sig, where) != at:
                    if at and pairs_of(cell, named, sent):
                        again.append(at[0])
                    at, cell = (sig, where), []
                sketch = known.get(key)
                if sketch is None:
                    if len(known) >= 50_000:
                        known.clear()
                    sketch = known[key] = Sketch(sketches[row].as_py())
                cell.append((key, component, n, sketch, here, asking))
            if named or again:
                yield rows_of(list(named), again)
            sent |= named
            named = set()
            if len(sent) > PAIRS_HELD:
                sent = set()
        again = [at[0]] if at and pairs_of(cell, named, sent) else []
        if named or again:
            yield rows_of(list(named), again)

    return saved(full.repartition("lead", "cell").sortWithinPartitions("lead", "cell", "sig", "key").drop("lead")
                     .mapInArrow(tidy(run), "a long, b long, sig long"), "asked")


def jaccard_classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                    num: int = NUM, den: int = DEN, asks: int = ASKS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: similar documents share a component."""
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    collected = _collected(docs, max(1, -(-size // BUCKET_BYTES)), width, num, den)
    zipped = F.explode(F.arrays_zip("ids", "sizes", "keys", "sketches"))
    rows = collected.filter(F.col("kind") == MEMBERS).select(zipped.alias("m")).select(
        F.col("m.ids").alias("doc_id"), F.col("m.sizes").alias("n_shingles"), F.col("m.keys").alias("key"),
        F.col("m.sketches").alias("sketch"))
    members = rows.drop("sketch")
    groups = collected.filter(F.col("kind") != MEMBERS).select("kind", "sig", "keys")

    # neighbours within each group
    count = F.size("keys")
    chain = F.explode(F.arrays_zip(F.slice("keys", 1, count - 1).alias("a"), F.slice("keys", 2, count - 1).alias("b")))
    neighbours = groups.filter(count > 1).select(chain.alias("p")).select("p.a", "p.b").distinct()
    sketched = rows.filter("sketch is not null").select("key", F.col("n_shingles").alias("n"), "sketch")
    shapes = saved(sketched.join(groups.select(F.explode("keys").alias("key")).distinct(), "key", "left_semi")
                           .dropDuplicates(["key"]), "shapes")
    new = saved(_allowed(neighbours, shapes, num, den), "pairs")
    met = new  # allowed pairs that were compared
    larger, limit = _open_groups(groups), asks
    least = members.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    labels = df.sparkSession.createDataFrame([], "node long, component long")
    sets = None
    while True:
        if not new.isEmpty():
            wanted = new.select(F.col("a").alias("key")).unionAll(new.select("b")).distinct()
            if sets is not None:
                wanted = wanted.join(sets.select("key"), "key", "left_anti")
            wanted = saved(wanted.join(least, "key"), "wanted")
            if not wanted.isEmpty():
                more = _class_sets(docs, wanted, width)
                sets = more if sets is None else sets.unionAll(more)
            found = saved(_compared(new, sets, num, den), "links")
            if not found.isEmpty():
                # the components known so far are stars already: only what the new links join has to move
                labels = components(labels.toDF("a", "b").unionAll(found))
        if met is None:
            break  # every allowed pair of different components was named and compared
        asked = _further(larger, labels, shapes, limit, num, den)
        new = saved(asked.filter("a is not null").select("a", "b").distinct().join(met, ["a", "b"], "left_anti"), "pairs")
        again = asked.filter("sig is not null").select("sig").distinct()
        met = None if again.isEmpty() else met.unionAll(new)
        larger, limit = larger.join(again, "sig", "left_semi"), limit * 4

    classes = members.filter("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    named = saved(classes.join(labels.withColumnRenamed("node", "key"), "key", "left"), "named")
    linked = named.filter("component is not null").withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
    firsts = linked.groupBy("component").agg(F.min("least").alias("component_id")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    classes = linked.join(firsts, ["component", "salt"]).select("key", "component_id").unionAll(
        named.filter("component is null").select("key", F.col("least").alias("component_id")))
    found = members.filter("n_shingles > 0").join(classes, "key").select("doc_id", "n_shingles", "component_id")
    empty = members.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionAll(empty)


def first_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` whose id names their component.

    Rows without an id stay.  Where ids repeat, rows equal in id and text count once.
    A bit table of the ids that go lets most others stay where they lie; only the rows
    that it marks meet the ids in an exact join.
    """
    classes = saved(jaccard_classes(df, doc_id, text, **options), "classes")
    names = classes.filter("doc_id = component_id").groupBy(F.col("doc_id").alias("_kf_id")).agg(
        F.count(F.lit(1)).alias("_kf_n"))
    gone = saved(classes.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("first"))
                        .filter("not first").select(F.xxhash64("doc_id").alias("key")), "gone")
    number = F.col(f"`{doc_id}`").cast("long")
    rows = marked_in(df.filter(number.isNotNull()).withColumn("_kf_key", F.xxhash64(number)), "_kf_key", [gone])
    some = rows.filter("_kf_marks > 0").join(names.select("_kf_id"), number == F.col("_kf_id"), "left_semi")
    kept = rows.filter("_kf_marks = 0").unionByName(some).select(*[f"`{c}`" for c in df.columns])
    if not names.filter("_kf_n > 1").isEmpty():
        kept = kept.dropDuplicates([doc_id, text])
    return kept.unionAll(df.filter(F.col(f"`{doc_id}`").isNull()))


def op2_jaccard(spark, sf_dir):
    """Components of similar documents over five-word shingles."""
    docs = table(spark, sf_dir, "documents")
    return jaccard_classes(docs)

"""Id files, importance resampling and phrase mining against plain versions; registered queries on small folders."""

import hashlib
import io
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keyflow.llm import common, idfiles, importance, jaccard, mixing, phrases, toxicity
from keyflow.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def public(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def corpus():
    rng = random.Random(5)
    words = "the of and night Night river New York stone-wall it's a42 naïve café ß İ 中文 😀 x".split(" ")
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", " ", ", ", ".\n", "\t", "; "]) for _ in range(rng.randint(1, 90))) for _ in range(120)]
    texts += ["new york night river " * 40, None, "", " \n\t ", "x" * 20_000, "long word " * 30_000, "<|endoftext|> <|STARTOFTEXT|>!?"]
    rows = [(i * 3, t, [None, "en", "de", ""][i % 4], None if i % 5 == 0 else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[0], (None, "no id here", "en", "s1", 10), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


# -- Huffman-coded id files ---------------------------------------------------

def kraft(lengths):
    return sum(2.0 ** -int(n) for n in lengths if n)


@pytest.mark.parametrize("limit", [4, 6, 16])
def test_code_lengths_are_optimal_under_the_limit(limit):
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 9, 16):
        counts = (rng.pareto(0.6, n) * 20 + 1).astype(np.int64)
        lengths = idfiles.code_lengths(counts, limit)
        assert lengths.max() <= limit and kraft(lengths) <= 1
        best = min_cost(sorted(counts.tolist(), reverse=True), limit) if n > 1 else counts.sum()
        assert int((lengths * counts).sum()) == best
    assert idfiles.code_lengths(np.zeros(5, np.int64)).tolist() == [0] * 5


def min_cost(counts, limit):
    """Cheapest code by trying all numbers of codes per length, longer codes for smaller counts."""
    best = [math.inf]

    def go(at, length, room, cost):
        if cost >= best[0]:
            return
        if at == len(counts):
            best[0] = cost
            return
        if length > limit:
            return
        for here in range(min(room, len(counts) - at), -1, -1):
            if (room - here) * 2 ** (limit - length) >= len(counts) - at - here:
                go(at + here, length + 1, 2 * (room - here), cost + length * sum(counts[at:at + here]))

    go(0, 1, 2, 0)
    return best[0]


def test_packed_ids_are_read_back_and_from_the_middle():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.3, 5000), 900).astype(np.uint32)
    lengths = idfiles.code_lengths(np.bincount(ids, minlength=1000))
    codes, entries, bits = idfiles.canonical(lengths)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    assert (np.diff([int(codes[i]) << (bits - int(lengths[i])) for i in order]) > 0).all()   # canonical: in order of length and id
    for n in (0, 1, 127, 128, 129, 5000):
        points, data = idfiles.pack(ids[:n], codes, lengths)
        assert (idfiles.unpack(data, points, n, entries, bits) == ids[:n]).all() and len(points) == -(-n // 128)
    out = io.BytesIO()
    out.close, size = lambda: None, 777
    writer = idfiles.IdWriter(out, lengths, codes, block=size, every=16)
    cuts = [0, 0, 5, 800, 801, 4000, 5000]
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        writer.add(None if i == 0 else i, ids[a:b])
    writer.close()

    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    file = idfiles.IdFile(Source(out.getvalue()), "f")
    got = [(i, at, np.concatenate(p).tolist() if p else []) for i, at, p in file]
    assert got == [(None if i == 0 else i, a, ids[a:b].tolist()) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    for a, b in ((0, 1), (15, 17), (776, 779), (100, 4999), (4999, 5000), (7, 7)):
        assert (file.ids(a, b) == ids[a:b]).all()
    whole = out.getvalue()
    for broken in (whole[:-1], whole[:40], b"", whole[:1500] + bytes([whole[1500] ^ 1]) + whole[1501:]):
        with pytest.raises((ValueError, zlib.error)):
            list(idfiles.IdFile(Source(broken), "f"))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name):
    from tokenizers import Tokenizer

    pieces = ["a", "B", "é", "É", "é", "ß", "ſ", "İ", "Σ", "ΑΣ", "漢", "42", "½", "'s", "'LL", "’s", ".", "!?", "...", ";:", "-", "<|endoftext|>",
              "<|STARTOFTEXT|>", "<|", " ", "  ", "\n", "\t", "\r\n", "\x1c", " ", "\xa0", "̇", "😀", "ª", "x" * 30]
    rng = random.Random(2)
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(3000)] + ["", "word " * 5000]
    encoder = idfiles.TextEncoder(open(public(name), encoding="utf-8").read())
    library = Tokenizer.from_file(public(name))
    for _ in range(2):     # the second time every word is known
        ids, ends = encoder.encode(pa.array(texts, pa.large_string()))
        for i, coded in enumerate(library.encode_batch(texts, add_special_tokens=False)):
            assert ids[ends[i]:ends[i + 1]].tolist() == coded.ids, texts[i]


def test_id_files_equal_the_plain_encoding(spark, rows, monkeypatch):
    from tokenizers import Tokenizer

    path = public("word_bpe_49k.json")
    size = idfiles.vocabulary_size(path)
    df = frame(spark, rows).withColumn("ids", F.lit("clash")).withColumn("id", F.lit("clash")).repartition(3)
    coded = idfiles.encoded(df, path, end_id=1)
    counts = idfiles.id_counts(coded, size)
    manifest = idfiles.write_ids(coded, size, idfiles.code_lengths(counts), ids_per_file=20_000, total=int(counts.sum())).cache()
    got = idfiles.read_ids(manifest).collect()
    library = Tokenizer.from_file(path)
    plain = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in rows]
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter((d, tuple(i)) for d, i in plain)
    assert all(r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in in_order] == np.cumsum([0, *(r.n_tokens for r in in_order)])[:-1].tolist()
    assert [r.doc_id for r in in_order] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d))
    files = manifest.orderBy("file").collect()
    assert len(files) > 1 and [f.start for f in files] == np.cumsum([0, *(f.ids for f in files)])[:-1].tolist()


# -- importance resampling ----------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_resampling(rows, target, longest, buckets, seed, least, percent):
    def grams(text):
        w = WORD.findall(ascii_lower(text))
        return w, [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    place = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(place(f) for x in texts for f in grams(x)[1]) for texts in ([r[1] for r in rows], target))
    total = lambda c: sum(c.values()) + buckets
    gain = {b: math.floor(1000 * math.log(float(t[b] + 1) * total(s) / (float(s[b] + 1) * total(t)))) for b in range(buckets)}
    out = []
    for doc_id, text, *_ in rows:
        w, f = grams(text)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[place(x)] for x in f)
        out.append((doc_id, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    good = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0], r[2]))
    places = {}
    for i, r in enumerate(good[:len(good) * percent // 100]):
        places.setdefault(r, []).append(i + 1)
    return Counter((*r, places[r].pop(0) if places.get(r) else None) for r in sorted(out, key=repr))


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_equals_the_plain_version(spark, rows, longest, monkeypatch):
    from keyflow.llm import common

    monkeypatch.setattr(common, "ROWS_PER_RANGE", 10)    # many ranges
    target = ["new york night", None, "", "The café, the river"]
    df = frame(spark, rows).withColumn("score", F.lit("clash")).repartition(4)
    got = importance.resampled(df, spark.createDataFrame([(t,) for t in target], "text string"), longest=longest, buckets=64, percent=40)
    found = Counter(tuple(r) for r in got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect())
    assert found == plain_resampling(rows, target, longest, 64, 2024, 20, 40)
    assert "text" not in got.columns and "lang" in got.columns


def test_resampling_of_empty_tables(spark, rows):
    empty, target = frame(spark, []), spark.createDataFrame([], "text string")
    assert importance.resampled(empty, target).count() == 0
    assert importance.resampled(frame(spark, rows), target).count() == len(rows)


# -- phrase mining ------------------------------------------------------------

def plain_phrases(rows, longest, least, absorbed, top):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", ascii_lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    dropped = {(lang, w[i:i + m]) for (lang, w), a in candidates.items() for m in range(2, len(w)) for i in range(len(w) - m + 1)
               if 100 * a >= absorbed * f[lang, w[i:i + m]]}
    out = []
    for (lang, w), a in candidates.items():
        if (lang, w) not in dropped:
            cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    ranked = set()
    for lang in {r[0] for r in out}:
        best = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked |= {(r[0], i + 1, *r[1:]) for i, r in enumerate(best)}
    return ranked


@pytest.mark.parametrize("least,chunk,counters", [(30, 1 << 22, 1 << 19), (3, 500, 1 << 16)])
def test_phrases_equal_the_plain_version(spark, rows, monkeypatch, least, chunk, counters):
    """Also with tiny chunks and summaries, so that summaries are merged and cut."""
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    monkeypatch.setattr(phrases, "COUNTERS", counters)
    monkeypatch.setattr(phrases, "HELD", 40 if chunk < 1000 else 1 << 19)
    df = frame(spark, rows).withColumn("phrase", F.lit("clash")).repartition(5)
    got = phrases.collocations(df, least=least, top=50).collect()
    assert {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got} == plain_phrases(rows, 4, least, 80, 50)
    assert len(got) > 0


def test_phrases_of_an_empty_table(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0


def test_summaries_keep_every_frequent_key_within_their_capacity():
    rng = np.random.default_rng(9)
    keys = rng.zipf(1.4, 60_000).astype(np.uint64)
    least, mass = 60, len(keys)
    summary = phrases.Summary(mass // least + 1)
    for part in np.array_split(keys, 40):
        k, c = np.unique(part, return_counts=True)
        summary.add(k, c.astype(np.int64))
        assert len(summary.keys) <= summary.capacity
    found = set(summary.frequent(least).tolist())
    assert 0 < summary.error < least
    assert {int(k) for k, c in zip(*np.unique(keys, return_counts=True), strict=True) if c >= least} <= found


# -- toxicity -----------------------------------------------------------------

def plain_evidence(training, texts, alpha):
    """Kneser-Ney over word pairs as the formulas say, with plain dictionaries."""
    words = lambda t: [m.lower() for m in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (t or "").encode())]
    n = [Counter(), Counter()]
    for text, toxic in training:
        w = words(text)
        n[toxic].update(zip([None, *w], w, strict=False))
    discount = lambda counts: (lambda a, b: a / (a + 2 * b) if a else 0.5)(*(sum(v == k for v in counts.values()) for k in (1, 2)))
    occurs = [Counter(), Counter()]
    for c in (0, 1):
        for (_, w), x in n[c].items():
            occurs[c][w] += x
    follow = [Counter(w for _, w in c) for c in n]
    e = [discount(c) for c in follow]
    vocabulary = set(follow[0]) | set(follow[1])
    both = {w: min(follow[0][w], follow[1][w]) for w in vocabulary}
    every = sum(v + 0.5 for v in both.values())
    mass = [sum(max(v - e[c], 0) for v in follow[c].values()) for c in (0, 1)]
    lent = max(1 - mass[c] / sum(follow[c].values()) for c in (0, 1))
    p = [{w: (1 - lent) * max(follow[c][w] - e[c], 0) / mass[c] + lent * (both[w] + 0.5) / every for w in vocabulary} for c in (0, 1)]
    k = [Counter(), Counter()]
    for c in (0, 1):
        for (v, _), x in n[c].items():
            k[c][v] += x - 1
    log = lambda r: math.log(1 - alpha + alpha * r)
    out = []
    for text in texts:
        w = words(text)
        of_words = of_pairs = 0.0
        for v, x in zip([None, *w], w, strict=False):
            if x not in vocabulary:
                continue
            base = log(p[1][x] / p[0][x])
            of_words += base
            if v is not None and (n[0][v, x] > 1 or n[1][v, x] > 1) and k[0][v] > 0 and k[1][v] > 0:
                back = max(1 - k[c][v] / occurs[c][v] for c in (0, 1))
                q = [(1 - back) * max(n[c][v, x] - 1, 0) / k[c][v] + back * p[c][x] for c in (0, 1)]
                of_pairs += log(q[1] / q[0]) - base
        out.append((of_words / len(w), of_pairs / len(w)) if w else None)
    return out


@pytest.mark.parametrize("hot", [(1 << 18, 1 << 20), (20, 30), (0, 0)])
def test_evidence_equals_the_plain_model(spark, monkeypatch, hot):
    """Whether entries go to every task or are joined, sums are those of the plain model."""
    monkeypatch.setattr(toxicity, "HOT_WORDS", hot[0])
    monkeypatch.setattr(toxicity, "HOT_PAIRS", hot[1])
    monkeypatch.setattr(toxicity, "CHUNK_PAIRS", 300)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ärger", "É", "42"]
    text = lambda bad: " ".join(rng.choice(vocabulary + (["vile", "foe"] * 6 if bad else [])) + rng.choice(["", ".", "\n"]) for _ in range(40))
    training = [(text(i % 5 == 0), int(i % 5 == 0)) for i in range(60)]
    texts = [training[0][0], training[1][0], text(True), text(False), "vile foe vile foe", "unknown words only", "", None, "the VILE foe " * 3000]
    counts = toxicity.pair_counts(spark.createDataFrame(training, "text string, toxic int").repartition(3), 8)
    words, of_pairs = toxicity.evidence(counts, 0.01)
    df = spark.createDataFrame([(t,) for t in [*texts, texts[4]]], "text string").repartition(4)
    got = {r.key: (r.of_words, r.of_pairs) for r in toxicity.text_evidence(df, "text", words, of_pairs).collect()}
    keys = [r.k for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(
        F.xxhash64(F.coalesce("t", F.lit(""))).alias("k")).collect()]
    for key, want in zip(keys, plain_evidence(training, texts, 0.01), strict=True):
        assert (key in got) == (want is not None)
        if want:
            assert got[key] == pytest.approx(want, rel=1e-9, abs=1e-12)


class Captured:
    """Stands for a DataFrame of texts; keeps the functions that workers would run."""

    def __init__(self, spark=None):
        self.sparkSession, self.steps = spark, []

    def mapInArrow(self, step, schema):
        self.steps.append(step)
        return self

    def __getattr__(self, name):
        return lambda *_: self


def test_workers_of_toxicity_take_bounded_memory(spark, monkeypatch):
    """What a worker holds while it counts pairs or asks for entries: two of them share an executor with its JVM."""
    rng = np.random.default_rng(5)
    words = np.array([f"word{i}" for i in range(300_000)])
    texts = [" ".join(words[rng.integers(0, len(words), 900)]) for _ in range(3000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[a:a + 1000]), pa.array(range(a, a + 1000), pa.int64())], ["text", "x"])
               for a in range(0, 3000, 1000)]
    labelled = [b.set_column(1, "toxic", pa.array([i % 9 == 0 for i in range(b.num_rows)]).cast(pa.int32())) for b in batches]
    monkeypatch.setattr(toxicity, "saved", lambda df, name: df)
    counting, asking = Captured(), Captured(spark)
    toxicity.pair_counts(counting, 8)
    monkeypatch.setattr(toxicity, "HOT_WORDS", 1)  # all others are asked for
    h = np.unique(toxicity.text_words(*next(toxicity.pieces(pa.array(texts[:400], pa.large_string()), 1 << 24))[2:])[0])
    entries = spark.createDataFrame([(int(x), 2, 0.5) for x in h[:2000]], "word long, n long, e double")
    none = entries.limit(0).withColumnRenamed("word", "pair")
    monkeypatch.setattr(toxicity, "dealt_entries", lambda *_: None)
    toxicity.text_evidence(asking, "text", entries, none)
    monkeypatch.setattr(toxicity, "hit", lambda bits, keys: np.ones(len(keys), bool))  # the worst case
    for step, rows in ((counting.steps[0], labelled), (asking.steps[0], batches)):
        tracemalloc.start()
        try:
            sent = sum(b.num_rows for b in step(iter(rows)))
            most = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert sent >= 8 and most < 120e6


def private_mb():
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_worker_gives_back_what_a_step_took(spark):
    """Workers are used again for other steps: what one took must not stay beside what the next one takes."""
    stay = []

    def make():
        held = []

        def step(batch):
            for _ in range(6000):  # small blocks that stay between larger ones that do not
                held.append(np.ones(2500))
                if len(held) % 50 == 0:
                    stay.append(np.ones(8))
            return [pa.array([len(held)] * batch.num_rows, pa.int64())]
        return step

    class Frame(Captured):
        columns, schema = ["doc_id"], spark.createDataFrame([], "doc_id long").schema

    frame_ = Frame(spark)
    common.with_columns(frame_, ["doc_id"], common.T.StructType([common.T.StructField("n", common.T.LongType())]), make)
    common.release()
    before = private_mb()
    out = list(frame_.steps[0](iter([pa.RecordBatch.from_arrays([pa.array([1], pa.int64())] * 2, ["doc_id", "_in_0"])])))
    assert out[0].column(1).to_pylist() == [6000] and len(stay) == 120
    assert private_mb() - before < 30  # the step took 115 MB


def test_source_column_travels_once_in_small_batches(spark):
    rows = [(i, chr(97 + i) * 500_000) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    common.prepare(spark)

    def sizes(name):
        def step(batch):
            assert batch.schema.names == ["text"]
            return [pa.array([f"{t[0]}{batch.nbytes}" for t in batch.column(0).to_pylist()])]
        kind = common.T.StructType([common.T.StructField(name, common.T.StringType())])
        return common.with_columns(docs, ["text"], kind, lambda: step)

    beside, instead = sizes("seen"), sizes("text")  # the source passes through; the source is replaced
    assert beside.columns == ["doc_id", "text", "seen"] and instead.columns == ["doc_id", "text"]
    assert "_in_0" not in beside._jdf.queryExecution().optimizedPlan().toString()
    for got, column in ((beside, "seen"), (instead, "text")):
        got = {r["doc_id"]: r[column] for r in got.select("doc_id", column).collect()}
        assert [got[i][0] for i in range(24)] == [t[0] for _, t in rows]
        assert max(int(v[1:]) for v in got.values()) < 6e6


# -- the registered queries on small folders ----------------------------------

COLUMNS = {
    "op1_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op2_jaccard": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op3_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op7_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op8_simhash": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op9_shards": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op10_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op11_idfiles": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op12_importance": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
}


@pytest.fixture(scope="module")
def folders(spark, rows, tmp_path_factory):
    out = []
    for name, some in (("small", rows), ("empty", [])):
        at = str(tmp_path_factory.mktemp(name))
        frame(spark, some).withColumns({c: F.lit("clash") for c in ("ids", "key", "word", "shard", "score", "component")}).write.parquet(f"{at}/documents.parquet")
        labels = [(r[0], None, i % 2) for i, r in enumerate(some) if i % 3] + ([(None, 1, 1)] if some else [])
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
        spark.createDataFrame([(1, "new york night"), (2, None)][:len(some)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
        out.append(at)
    return out


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_queries_give_a_row_per_document_with_the_stated_columns(spark, folders, rows, name):
    got = QUERIES[name](spark, folders[0])
    kinds = dict(got.dtypes)
    for column in COLUMNS[name].split(", "):
        assert kinds[column.split()[0]] == column.split()[1], column
    found = got.collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    assert QUERIES[name](spark, folders[1]).count() == 0


def test_phrase_query_on_a_small_and_an_empty_folder(spark, folders, rows):
    got = QUERIES["op13_phrases"](spark, folders[0])
    assert {tuple(r) for r in got.collect()} == plain_phrases(rows, 4, 30, 80, 2000)
    assert QUERIES["op13_phrases"](spark, folders[1]).count() == 0


def test_shards_and_simhash_digests_equal_plain_ones(spark, folders, rows):
    plain = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in QUERIES["op9_shards"](spark, folders[0]).collect()) == plain
    got = QUERIES["op8_simhash"](spark, folders[0]).collect()
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((r[0], len(r[1] or "")) for r in rows)
    unique = {r[0]: r[1] or "" for r in rows if r[0] is not None and r[0] > 0}
    ids = sorted(unique, reverse=True)
    edited = {r.doc_id: r.edited_sha256 for r in got}
    for a, b in zip(ids[:-1], ids[1:], strict=True):
        t, half = unique[a], len(unique[a]) // 2
        assert edited[a] == hashlib.sha256((t[:len(t) - half] + unique[b][:half]).encode()).hexdigest()


# -- rows decided where they lie ------------------------------------------------

def test_planes_hold_hashes():
    h = np.sort(np.random.default_rng(2).integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2))
    for some in (h, h[:1], h[:0]):
        assert (toxicity.from_planes(toxicity.to_planes(some)) == some).all()
    cuts = toxicity.part_cuts(h, 7)
    assert cuts[0] == 0 and cuts[-1] == len(h) and (np.diff(cuts) > 0).all()


def narrow(df, key, sets):
    return common.marked_in(df, key, sets, 15)


def moved(df):
    """Most rows with a text in one exchange of a plan, which is run."""
    df.collect()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        for step in ("executedPlan", "plan") if node.nodeName().startswith(("AdaptiveSparkPlan", "ShuffleQueryStage", "BroadcastQueryStage")) else ():
            try:
                todo.append(getattr(node, step)())
            except Exception:  # noqa: BLE001, S112 - not this kind of node
                continue
        if node.nodeName() == "Exchange" and "text#" in node.output().mkString(","):
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return max(out, default=0)


def test_marked_rows_are_few_and_hold_all_keys(spark):
    df = spark.range(3000).withColumn("key", F.xxhash64("id"))
    sets = [df.filter("id < 300").select("key"), df.filter("id >= 300").select("key"), df.limit(0).select("key")]
    rows = narrow(df, "key", sets).collect()
    assert all(r["_kf_marks"] >> (r["id"] >= 300) & 1 for r in rows)
    assert 0 < sum(r["_kf_marks"] == 3 for r in rows) < 600 and max(r["_kf_marks"] for r in rows) == 3


@pytest.mark.parametrize("marked", [common.marked_in, narrow])
def test_stages_keep_what_the_plain_joins_keep(spark, monkeypatch, marked):
    for module in (toxicity, jaccard, mixing):
        monkeypatch.setattr(module, "marked_in", marked)
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(2500):
        text = " ".join(rng.choice(words + ["vile", "foe"] * 60 * (i % 8 == 0)) for _ in range(rng.randint(0, 14)))
        rows.append((i, rows[-1][1] if i % 9 == 4 else text, rng.choice(["a", "b", "c", None])))
    rows += [rows[7], rows[7], (None, "no id", "a"), (9000, None, "b"), (9001, "", None), (5, "another text", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    # toxicity
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(2500)], "doc_id long, toxic int")
    scored = toxicity.scored(df, labels)
    kept = toxicity.accepted(df, labels)
    want = Counter((r[0], r[1], r[2]) for r in scored.filter("predicted = 0").collect())
    assert kept.columns == df.columns and Counter(map(tuple, kept.collect())) == want and 0 < sum(want.values()) < len(rows) - 50
    # first rows of components
    classes = {(r.doc_id, r.component_id) for r in jaccard.jaccard_classes(df).collect()}
    firsts = {d for d, c in classes if d == c and d is not None}
    kept = jaccard.first_of_each(df)
    want = Counter({r for r in rows if r[0] in firsts} | {r for r in rows if r[0] is None})
    assert Counter(map(tuple, kept.collect())) == want and sum(want.values()) < len(rows) - 50
    # the mix
    want = Counter()
    for r in mixing.plan(df).collect():
        want[r.doc_id, r.source, r.size] += r.rows * r.base + r.extras
    got = mixing.mixed(df)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert got.columns == df.columns and Counter((r[0], r[2], size(r[1])) for r in got.collect()) == +want
    if marked is common.marked_in:  # most texts stay where they lie
        alone = df.filter("doc_id < 2500 and doc_id not in (5, 7)")
        assert all(moved(x) < len(rows) / 2 for x in (toxicity.accepted(alone, labels), jaccard.first_of_each(alone), mixing.mixed(alone)))

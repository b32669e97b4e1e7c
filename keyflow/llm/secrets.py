"""Secrets in texts (operator 3).

Every text is searched for three base kinds, leftmost and non-overlapping per
kind (a proposal that is too short is dropped and not tried again): ``assign``,
``access`` and ``hex``.  The method adds ``literal``: the text is lexed for
assignments (``name = value``, ``"name": "value"``, ``name := value``,
``name => value``, ``name: type = value``), whose right sides are sums of literals and names.  Names are
replaced by the literals that they were assigned earlier in the text (constant
propagation, also through chains), and each literal is scored by how sensitive
the name is that finally holds it and by how much the literal looks like a
secret.  Literals from ``min_score`` on are reported where they are written.

Defined cases: a null or empty text has no spans; offsets are code points, end
exclusive; a literal that reaches several sensitive names is reported once, with
its best score; rows are handled one by one, so repeated rows stay; added
columns replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from keyflow.llm.common import table, utf8, with_columns
from keyflow.llm.spans import counts, joined

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "literal")

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

# Parts of names and how sensitive they make what they hold.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
             "credential": 0.9, "credentials": 0.9, "apikey": 1.0, "auth": 0.7, "bearer": 0.8, "pin": 0.5}
KEY_OWNERS = {"api", "access", "private", "secret", "encryption", "signing", "master", "service", "account"}
# Literals that as a whole stand for a secret without being one.
PLACEHOLDER = re.compile(r"(?i)(?:x+|\*+|\.+|changeme|password|passwd|secret|token|example|placeholder|"
                         r"none|null|true|false|undefined|your[-_ ].*|test|todo|"
                         r"(?:\$?\{\{[^{}]*\}\}|\$?\{[^{}]*\}|\$\([^()]*\)|<[^<>]*>|%[a-z_][a-z0-9_]*%|(?-i:\$[A-Z_][A-Z0-9_]*+))+)")

# a name, what closes it, and the operator; every character is looked at once
ASSIGNMENT = re.compile(r"""(?<![A-Za-z0-9_.-])([A-Za-z0-9_.-]++)(?:["']?["'\]])?[ \t]*+(:=|=>|[:=])""")
# the type and the operator of a declaration ``name: type = value``
TYPE = re.compile(r"""[ \t]*+[&*]*+(?:'static[ \t]++)?[A-Za-z_][A-Za-z0-9_.]*+(?:\[[^\]\n=:]*+\]++|<[^>\n=:]*+>++|[?*!])*+"""
                  r"""(?:[ \t]*+\|[ \t]*+[A-Za-z_][A-Za-z0-9_.]*+(?:\[[^\]\n=:]*+\]++)?+)*+[ \t]*+=(?![=>~])""")
OPERAND = re.compile(r"""[ \t]*(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|([A-Za-z_][A-Za-z0-9_.]*)(?=[ \t]*(?:[+;,)\n]|$))"""
                     r"""|([^\s"',;(){}\[\]<>]+))""")
PLUS = re.compile(r"[ \t]*\+(?![=+])")
CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def sensitivity(name: str) -> float:
    """How sensitive a target name is, from 0 to 1."""
    words = [w.lower() for w in CAMEL.findall(name)]
    best = max((SENSITIVE.get(w, 0.0) for w in words), default=0.0)
    if "key" in words and KEY_OWNERS & set(words) or holds_phrase(name):
        best = 1.0
    return best


def holds_phrase(name: str) -> bool:
    """Whether what a name holds may have blanks."""
    return "passphrase" in "".join(CAMEL.findall(name)).lower()


def plausibility(literal: str, phrase: bool = False) -> float:
    """How much a literal looks like a secret: long enough, no placeholder, not monotonous, blanks in a ``phrase`` only."""
    if len(literal) < 6 or not phrase and " " in literal.strip() or PLACEHOLDER.fullmatch(literal):
        return 0.0
    n = len(literal)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    return min(1.0, 0.4 + entropy / 6)


def pairs(text: str):
    """(name, operands) of every assignment in order; an operand is (text, start, end, whether it may be a name)."""
    done = 0
    for found in ASSIGNMENT.finditer(text):
        at, end = found.span(2)
        if at < done:
            continue
        after = text[end:end + 2]
        if after[:1] in ("=", "~") or after == "//":
            continue
        name = found[1].lstrip("-.0123456789")
        if not name:
            continue
        typed = TYPE.match(text, end) if found[2] == ":" else None
        operands, end = [], typed.end() if typed else end
        while operand := OPERAND.match(text, end):
            kind = operand.lastindex
            operands.append((operand[kind], *operand.span(kind), kind == 3))
            end = operand.end()
            more = PLUS.match(text, end)
            if not more:
                break
            end = more.end()
        if operands:
            # operators inside a value belong to the value, so every character is lexed once; what looks
            # like a type may be a name (``note: password = "..."``), so it is assigned the value too
            if not typed:
                done = end
            yield name, operands


def literals(text: str, min_score: float = 0.5) -> list[tuple[str, int, int, float]]:
    """Scored literals of sensitive targets, constants propagated."""
    held: dict[str, list[tuple[str, int, int]]] = {}
    best: dict[tuple[int, int], float] = {}
    for name, operands in pairs(text):
        value: list[tuple[str, int, int]] = []
        for literal, a, b, may_be_name in operands:
            value += held.get(literal, ()) if may_be_name and literal in held else [(literal, a, b)]
        held[name] = value = list(dict.fromkeys(value))  # a literal counts once, so values cannot double
        weight = sensitivity(name)
        if weight:
            rate = round(weight * plausibility("".join(v[0] for v in value), holds_phrase(name)), 6)
            for _, a, b in value:
                if a < b and rate >= min_score and rate > best.get((a, b), 0.0):
                    best[a, b] = rate
    return [("literal", a, b, rate) for (a, b), rate in best.items()]


def find(text: str, min_score: float = 0.5) -> list[tuple[str, int, int, float]]:
    """All spans: base kinds with score 1, literals with their score."""
    out = [("assign", *m.span(), 1.0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [("access", *m.span(), 1.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span(), 1.0) for m in HEX.finditer(text)]
    if ":" in text or "=" in text:
        out += literals(text, min_score)
    return out


def redact(text: str, spans: list[tuple[str, int, int, float]], mask: str = "[SECRET]") -> str:
    """The text with every span replaced; of ``assign`` spans only the value goes."""
    cuts = []
    for kind, a, b, *_ in spans:
        if kind == "assign":
            a = ASSIGN.match(text, a).start(2)
        cuts.append((a, b))
    out, done = [], 0
    for a, b in sorted(cuts):
        if a >= done:
            out += [text[done:a], mask]
        done = max(done, b)
    return "".join([*out, text[done:]])


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))


def secret_spans(df: DataFrame, text: str = "text", spans: str = "secrets", min_score: float = 0.5) -> DataFrame:
    """Append ``secrets``: an array of (kind, start, end, score), by start then kind."""
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("score", pa.float64())]))
    rank = {k: i for i, k in enumerate(KINDS)}

    def make():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = [sorted(find(t, min_score), key=lambda s: (s[1], rank[s[0]], s[2]))
                    for t in utf8(batch.column(0)).to_pylist()]
            return [pa.array([[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in r]
                              for r in rows], arrow)]
        return step

    return with_columns(df, [text], T.StructType([T.StructField(spans, SPANS)]), make)


def redacted(df: DataFrame, text: str = "text", min_score: float = 0.5, mask: str = "[SECRET]") -> DataFrame:
    """``text`` with its secrets replaced by ``mask``; texts without any, and nulls, stay as they are."""
    def make():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            out = []
            for t in batch.column(0).to_pylist():
                spans = find(t, min_score) if t else []
                out.append(redact(t, spans, mask) if spans else t)
            return [pa.array(out, pa.string())]
        return step

    order = df.columns
    return with_columns(df, [text], T.StructType([T.StructField(text, T.StringType())]), make).select(
        *[f"`{c}`" for c in order])


def secret_digest(df: DataFrame, spans: str = "secrets") -> DataFrame:
    """Append counts per base kind, the digest of the base spans and all spans as text."""
    added = T.StructType([*[T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS],
                          T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def make():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = [[(s["kind"], s["start"], s["end"]) for s in r or ()] for r in batch.column(0).to_pylist()]
            base = [joined([s for s in r if s[0] in BASE_KINDS], KINDS) for r in rows]
            return [*[pa.array(counts(rows, k)) for k in BASE_KINDS],
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                    pa.array([joined(r, KINDS) for r in rows], pa.string())]
        return step

    return with_columns(df, [spans], added, make)


def op3_secrets(spark, sf_dir):
    """Secrets of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_digest(secret_spans(docs).drop("text")).drop("secrets")

"""Personal data in texts (operator 7).

Regular expressions propose spans, checksum and shape validators confirm them
(Luhn for cards, mod 97 for account numbers, ranges for addresses), and words
near a span raise or lower its score.

Kinds that every text is searched for, leftmost and non-overlapping per kind
(a proposal that its validator rejects is dropped and not tried again):
``email``, ``ip``, ``card``, ``phone``.  The method adds ``iban`` (two letters,
two check digits, mod 97 = 1, cut to the length of its country where that holds), ``local_phone`` (a national number such as
``(499) 555-6503``) and ``ssn`` (ddd-dd-dddd), which count from a score of
``min_score`` on.  The base kinds stay whatever their score is.

Defined cases: a null or empty text has no spans (digest of the empty string);
offsets are code points, end exclusive; rows are handled one by one, so ties and
repeated rows stay; added columns replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.llm.common import table, utf8, with_columns
from keyflow.llm.spans import counts, joined

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "local_phone", "ssn")

# The proposing patterns.
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
# Lengths of account numbers by country (IBAN registry).
IBAN_LENGTHS = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}
LOCAL_PHONE = re.compile(r"(?<![0-9+(])\([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

# First scores, and the words that move them.
START_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "local_phone": 0.5, "ssn": 0.4}
CONTEXT = {
    "email": re.compile(r"(?i)e-?mail|contact|write|reply"),
    "ip": re.compile(r"(?i)\bip\b|address|server|host|login"),
    "card": re.compile(r"(?i)card|visa|master|credit|payment|cvv|expir"),
    "phone": re.compile(r"(?i)phone|call|mobile|tel\b|fax|whatsapp"),
    "iban": re.compile(r"(?i)iban|account|bank|transfer|konto"),
    "local_phone": re.compile(r"(?i)phone|call|mobile|tel\b|fax|whatsapp"),
    "ssn": re.compile(r"(?i)ssn|social security|tax id"),
}
AGAINST = re.compile(r"(?i)version|example only|order no|invoice|isbn|serial")
CONTEXT_CHARS = 60
RAISE, LOWER = 0.3, 0.3


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Check digits of an international account number: first four characters last, letters as 10 to 35."""
    rest = 0
    for c in account[4:] + account[:4]:
        rest = (rest * (10 if c <= "9" else 100) + int(c, 36)) % 97
    return rest == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@``; linear also where no domain follows."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        elif start < at:
            done = max(done, at)  # another @ cannot begin before this one
        at = text.find("@", max(done, at + 1))


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans of every kind."""
    if "@" in text:
        for a, b in emails(text):
            yield "email", a, b
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield "card", *m.span()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                yield "phone", *m.span()
    at = 0
    while m := IBAN.search(text, at):
        at = m.end()
        ends = [m.end(), *(b for b in range(m.start(), m.end()) if text[b] == " ")]
        # a following upper-case token may have been taken in: first the length that the country fixes
        fixed = [b for b in ends if b - m.start() - text.count(" ", m.start(), b) == IBAN_LENGTHS.get(m.group()[:2])]
        for end in (*fixed, m.end()):
            account = text[m.start():end].replace(" ", "")
            if 15 <= len(account) <= 34 and mod97(account):
                yield "iban", m.start(), end
                at = end  # what was cut off may begin another
                break
    for m in LOCAL_PHONE.finditer(text):
        yield "local_phone", *m.span()
    for m in SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", *m.span()


def score(text: str, kind: str, start: int, end: int) -> float:
    """First score of the kind, moved by the words within ``CONTEXT_CHARS`` of the span."""
    near = text[max(0, start - CONTEXT_CHARS):start] + "\n" + text[end:end + CONTEXT_CHARS]
    value = START_SCORE[kind]
    if CONTEXT[kind].search(near):
        value += RAISE
    if AGAINST.search(near):
        value -= LOWER
    return round(min(1.0, max(0.0, value)), 6)


def find(text: str, min_score: float = 0.5) -> list[tuple[str, int, int, float]]:
    """Spans with their scores; base kinds always, others from ``min_score`` on."""
    out, phones = [], []
    for kind, a, b in proposals(text):
        if kind == "phone":
            phones.append((a, b))
        if kind == "local_phone" and any(x <= a and b <= y for x, y in phones):
            continue  # the same number, found with its country code
        value = score(text, kind, a, b)
        if kind in BASE_KINDS or value >= min_score:
            out.append((kind, a, b, value))
    return out


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))


def pii_spans(df: DataFrame, text: str = "text", spans: str = "pii", min_score: float = 0.5) -> DataFrame:
    """Append ``pii``: an array of (kind, start, end, score), by start then kind."""
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("score", pa.float64())]))
    rank = {k: i for i, k in enumerate(KINDS)}

    def make():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = [sorted(find(t, min_score), key=lambda s: (s[1], rank[s[0]]))
                    for t in utf8(batch.column(0)).to_pylist()]
            return [pa.array([[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in r]
                              for r in rows], arrow)]
        return step

    return with_columns(df, [text], T.StructType([T.StructField(spans, SPANS)]), make)


def pii_digest(df: DataFrame, spans: str = "pii") -> DataFrame:
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


def op7_pii(spark, sf_dir):
    """Personal data of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii_digest(pii_spans(docs).drop("text")).drop("pii")

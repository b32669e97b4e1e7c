"""Parsers against a plain-Python model of Java's split and parseLong on random lines."""

import random
import re

from keyflow.functions import accepted, parse_behavior, parse_page_log

ALPHABET = ["a", "b", "7", "0", "-", "+", " ", "|", ",", "\n", "é", "/x"]
LONG_MIN, LONG_MAX = -(2 ** 63), 2 ** 63 - 1


def java_split(s: str, sep: str) -> list[str]:
    """``String.split(sep)`` with limit 0: no match returns [s]; trailing empties dropped."""
    parts = s.split(sep)
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def parse_long(text: str):
    if not re.fullmatch(r"[+-]?[0-9]+", text):
        return None
    v = int(text)
    return v if LONG_MIN <= v <= LONG_MAX else None


def lines(seed: int, n: int = 3000) -> list[str]:
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        k = rnd.randint(0, 14)
        out.append("".join(rnd.choice(ALPHABET) for _ in range(k)))
    out += ["9223372036854775807", "a,b,c,9223372036854775807", "a,b,c,9223372036854775808",
            "a,b,c,-9223372036854775808", "a,b,c,+", "a,b,c,", ",,,", "|||", "a|b|c"]
    return out


def test_page_log_parser_matches_java_model(spark):
    data = lines(11)
    df = spark.createDataFrame(list(enumerate(data)), "i int, line string")
    got = {r.i: r.page for r in parse_page_log(df, "line", keep=("i",)).collect()}
    want = {}
    for i, s in enumerate(data):
        parts = java_split(s, "|")
        if len(parts) >= 3:
            want[i] = parts[2]
    assert got == want


def test_behavior_parser_matches_java_model(spark):
    data = [s.replace("|", ",") for s in lines(23)]
    df = spark.createDataFrame(list(enumerate(data)), "i int, line string")
    got = {r.i: (r.user_id, r.item_id, r.behavior_type, r.ts_ms)
           for r in accepted(parse_behavior(df, "line", keep=("i",))).collect()}
    want = {}
    for i, s in enumerate(data):
        parts = java_split(s, ",")
        if len(parts) == 4 and parse_long(parts[3]) is not None:
            want[i] = (parts[0], parts[1], parts[2], parse_long(parts[3]))
    assert got == want

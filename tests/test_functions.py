"""Stateless functions: tokenizer, lengths, parsers, numeric maps (fixtures A1-A6, C1, C2)."""

import pytest

from keyflow.functions import (accepted, doubled, guarded_double, guarded_double_strict, is_even,
                               parse_behavior, parse_behavior_json, parse_page_log, rejected,
                               text_length, tokenize, upper_text)
from keyflow.operators import word_count


def test_tokenize_lowercases_and_drops_empty(spark):
    df = spark.createDataFrame([(" Stream  and\tBatch\n",), ("数据流处理 engine",), ("",)], "line string")
    words = sorted(r.word for r in tokenize(df, "line").collect())
    assert words == ["and", "batch", "engine", "stream", "数据流处理"]


def test_tokenize_no_break_space_is_not_a_separator(spark):
    df = spark.createDataFrame([("a b c",)], "line string")
    assert sorted(r.word for r in tokenize(df, "line").collect()) == ["a b", "c"]


def test_word_count_counts_across_lines(spark):
    df = spark.createDataFrame([("one two two",), ("Two three",)], "text string")
    got = {r.word: r.cnt for r in word_count(df).collect()}
    assert got == {"one": 1, "two": 3, "three": 1}


def test_text_length_counts_utf16_units(spark):
    df = spark.createDataFrame([("abc",), ("a\U0001F600",), ("数据",)], "t string")
    got = [r[0] for r in df.select(text_length("t")).collect()]
    assert got == [3, 3, 2]
    cp = [r[0] for r in df.select(text_length("t", "codepoints")).collect()]
    assert cp == [3, 2, 2]


def test_length_filter_keeps_at_least_30(spark):
    lines = ["x" * 45, "y" * 54, "z" * 29, "w" * 30]
    df = spark.createDataFrame([(s,) for s in lines], "t string")
    kept = df.select("t", text_length("t").alias("n")).filter("n >= 30").collect()
    assert sorted(r.n for r in kept) == [30, 45, 54]


def test_upper(spark):
    df = spark.createDataFrame([("Hello Stream",)], "t string")
    assert df.select(upper_text("t")).first()[0] == "HELLO STREAM"


def test_double_then_even(spark):
    df = spark.range(1, 11).withColumnRenamed("id", "n")
    out = df.select(doubled("n").alias("d")).filter(is_even("d"))
    assert [r.d for r in out.orderBy("d").collect()] == list(range(2, 21, 2))


def test_guarded_double_quarantine_and_strict(spark):
    df = spark.range(0, 25).withColumnRenamed("id", "v")
    rows = {r.v: (r.doubled, r.quarantined) for r in guarded_double(df, "v").collect()}
    assert rows[0] == (0, False) and rows[7] == (14, False)
    assert rows[10] == (None, True) and rows[20] == (None, True)
    with pytest.raises(Exception):
        df.select(guarded_double_strict("v")).collect()
    ok = spark.range(1, 10).select(guarded_double_strict("id").alias("d")).collect()
    assert sorted(r.d for r in ok) == list(range(2, 19, 2))


def test_page_log_parser_fixture_c1(spark):
    lines = ["1|u|/a", "1|u", "1|u|", "1|u||x", "1|u|/a|z", ""]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, line string")
    got = {r.i: r.page for r in parse_page_log(df, "line", keep=("i",)).collect()}
    assert got == {0: "/a", 3: "", 4: "/a"}


def test_page_log_parser_keeps_trailing_newline_field(spark):
    df = spark.createDataFrame([("1|u||\n",)], "line string")
    assert [r.page for r in parse_page_log(df, "line").collect()] == [""]


def test_behavior_parser_fixture_c2(spark):
    lines = ["u,i,pv,5", "u,i,pv,5,,", "u,i,pv", "u,i,pv, 5", "u,i,pv,x", ",,,5", "",
             "u,i,pv,99999999999999999999", "u,i,pv,+7", "u,i,pv,5\n"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, line string")
    parsed = parse_behavior(df, "line", keep=("i",))
    ok = {r.i: (r.user_id, r.item_id, r.behavior_type, r.ts_ms) for r in accepted(parsed).collect()}
    assert ok == {0: ("u", "i", "pv", 5), 1: ("u", "i", "pv", 5), 5: ("", "", "", 5),
                  8: ("u", "i", "pv", 7)}
    bad = {r.i: r.reject_reason for r in rejected(parsed).collect()}
    assert bad == {2: "field_count", 3: "bad_number", 4: "bad_number", 6: "field_count",
                   7: "out_of_range", 9: "bad_number"}


def test_behavior_json_parser(spark):
    rows = ['{"userId":"u","itemId":"i","behaviorType":"pv","timestamp":5}', '{"k": 1}', "nope"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(rows)], "i int, value string")
    parsed = parse_behavior_json(df, "value", keep=("i",))
    assert [(r.i, r.behavior_type, r.ts_ms) for r in accepted(parsed).collect()] == [(0, "pv", 5)]
    assert sorted(r.i for r in rejected(parsed).collect()) == [1, 2]

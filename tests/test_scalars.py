from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import functions as F

from tallyloom.functions import scalars


def one(spark, column, ddl, *values):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(column).collect()]


def test_rounded_int_rounds_halves_to_even(spark):
    assert one(spark, scalars.rounded_int(F.col("x")), "x double", 1.7, 0.5, 1.5, -1.5, -0.4, None) == [2, 0, 2, -2, 0, None]


def test_size_pretty_steps(spark):
    sizes = {0: "0 bytes", 10239: "10239 bytes", 10240: "10 kB", 10485247: "10239 kB", 10485248: "10 MB",
             1536 * 1024 * 1024: "1536 MB", -20480: "-20 kB", 5 * 1024 ** 4: "5120 GB", 30 * 1024 ** 5: "30 PB"}
    got = one(spark, scalars.size_pretty(F.col("x")), "x long", *sizes)
    assert dict(zip(sizes, got)) == sizes
    assert one(spark, scalars.size_pretty(F.col("x")), "x long", None) == [None]


def test_percent_saved(spark):
    df = spark.createDataFrame([(1000, 100), (3, 2), (0, 0)], "b long, a long")
    got = [r[0] for r in df.select(scalars.percent_saved(F.col("b"), F.col("a"))).collect()]
    assert got == [Decimal("90.00"), Decimal("33.33"), None]


def test_array_literal(spark):
    assert one(spark, scalars.parse_array_literal(F.col("x")), "x string", "{ab,cd}", "{}", "{a}", None) == [
        ["ab", "cd"], [], ["a"], None]


def test_vector_literal(spark):
    assert one(spark, scalars.parse_vector(F.col("x")), "x string", "[1.0, 0.5,0]") == [[1.0, 0.5, 0.0]]


def test_segment_key(spark):
    assert one(spark, scalars.segment_key(F.col("x"), 3), "x string", "abcdef", "ab", "") == ["def", "ab", ""]


def test_chat_messages_and_answer(spark):
    text = one(spark, scalars.chat_messages("be brief", F.col("x")), "x string", 'two "lines"\nhere')[0]
    assert json.loads(text) == [{"role": "system", "content": "be brief"}, {"role": "user", "content": 'two "lines"\nhere'}]
    reply = json.dumps({"choices": [{"message": {"content": "fine"}}, {"message": {"content": "no"}}]})
    assert one(spark, scalars.answer_text(F.col("x")), "x string", reply, "{}") == ["fine", None]


def test_array_literals_with_quotes_and_nulls(spark):
    from tallyloom.functions.scalars import parse_array_literal
    cases = {'{a,b}': ["a", "b"], '{}': [], '{"a,b",c}': ["a,b", "c"], '{a,NULL,null,"NULL"}': ["a", None, None, "NULL"],
             r'{"say \"hi\"","back\\slash"}': ['say "hi"', "back\\slash"], '{""}': [""], '{ a , b }': ["a", "b"], '{"{x}",y}': ["{x}", "y"], '{1}': ["1"]}
    df = spark.createDataFrame(list(cases.items()) + [(None, None)], "t string, want array<string>")
    for r in df.select("t", "want", parse_array_literal(df.t).alias("got")).collect():
        assert r.got == r.want, r.t

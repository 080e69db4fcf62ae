"""Column functions on hand-written rows."""

import math

import pytest
from pyspark.sql import functions as F

from tarnwater.functions import arrays, bits, numeric, random
from tarnwater.functions.text import STOP_WORDS, ngrams, tokens
from tarnwater.functions.weblog import log_fields


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit_array(values, dtype="double"):
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{dtype}>")


@pytest.mark.parametrize(
    "line, expected",
    [
        ('h1.de - - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 512', ("h1.de", "01/Jul/1995:00:00:01 -0400", "GET /a HTTP/1.0", 200, 512)),
        ('h1.de - - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 -', ("h1.de", "01/Jul/1995:00:00:01 -0400", "GET /a HTTP/1.0", 200, None)),
        ("x", ("", "", "", None, None)),
        ("", ("", "", "", None, None)),
    ],
)
def test_log_fields(spark, line, expected):
    row = spark.createDataFrame([(line,)], "value string").select(*log_fields(F.col("value")).values()).first()
    assert tuple(row) == expected


def test_bucket_limits_and_flags(spark):
    rows = spark.createDataFrame([(99.0,), (100.0,), (None,)], "v double")
    labels = rows.select(numeric.bucket_label(F.col("v"), 100, "low", "high").alias("b"), numeric.flag_above(F.col("v"), 99).alias("f"))
    assert [tuple(r) for r in labels.collect()] == [("low", 0), ("high", 1), (None, 0)]


def test_tokens_and_ngrams(spark):
    assert one(spark, tokens(F.lit("U.S. won."))) == ["us", "won"]
    assert one(spark, tokens(F.lit("  The cat\tIS  in the Hat "), STOP_WORDS)) == ["cat", "hat"]
    assert one(spark, tokens(F.lit(""))) == [] and one(spark, tokens(F.lit(None).cast("string"))) == []
    words = spark.createDataFrame([(["a1", "b1", "c1"],), ([],), (["z"],)], "w array<string>")
    got = [r["g"] for r in words.select(ngrams(F.col("w"), 1, 2).alias("g")).collect()]
    assert got == [["a1", "b1", "c1", "a1 b1", "b1 c1"], [], ["z"]]
    assert [r["g"] for r in words.select(ngrams(F.col("w"), 2, 3).alias("g")).collect()] == [["a1 b1", "b1 c1", "a1 b1 c1"], [], []]


def test_stop_word_list():
    assert len(STOP_WORDS) == 57 and len(set(STOP_WORDS)) == 55


def test_digits_in_text(spark):
    assert one(spark, F.regexp_extract_all(F.lit("on 7 of 0012 days, x31y"), F.lit("([0-9]+)"), F.lit(1))) == ["7", "0012", "31"]


def test_bits(spark):
    assert one(spark, bits.binary_text(F.lit(5), 8)) == "00000101"
    assert one(spark, bits.binary_text(F.lit((1 << 33) + 5), 32)) == "1" + "0" * 30 + "101"
    assert one(spark, bits.parity(F.lit(0b1011), 0b0011)) == 0
    table = [14, 4, 13, 1, 2, 15, 11, 8, 3, 10, 6, 12, 5, 9, 0, 7]
    inverse = bits.inverse_permutation(table)
    assert [inverse[v] for v in table] == list(range(16))
    assert one(spark, bits.nibble_lookup(F.lit(0x1F), table)) == 0x47


def test_arrays(spark):
    a = lit_array([3.0, 1.0, 2.0])
    assert one(spark, arrays.dot(a, a)) == 14.0
    assert one(spark, arrays.array_argmax(a)) == 0 and one(spark, arrays.array_mean(a)) == 2.0
    assert one(spark, arrays.array_mean(lit_array([]))) is None
    assert one(spark, arrays.last_n(a, 2)) == [1.0, 2.0] and one(spark, arrays.last_n(a, 9)) == [3.0, 1.0, 2.0]
    assert one(spark, arrays.positions_where(a, lambda x: x > 1.5)) == [0, 2]
    assert one(spark, arrays.take_positions(a, lit_array([2, 0], "int"))) == [2.0, 3.0]
    assert one(spark, arrays.reshape(lit_array([1, 2, 3, 4, 5, 6]), 2, 3)) == [[1, 2, 3], [4, 5, 6]]
    assert one(spark, arrays.outer(lit_array([1, 2]), lit_array([3, 4]))) == [[3, 4], [6, 8]]
    assert [tuple(p) for p in one(spark, arrays.zip_shortest(lit_array([1, 2, 3]), lit_array([9, 8])))] == [(1, 9), (2, 8)]


def test_clip_keeps_missing_values(spark):
    values = F.array(F.lit(1.0), F.lit(None).cast("double"), F.lit(float("nan")), F.lit(-5.0))
    low, missing, nan, high = one(spark, arrays.clip_array(values, -0.1, 0.1))
    assert (low, missing, high) == (0.1, None, -0.1) and math.isnan(nan)
    assert math.isnan(one(spark, numeric.clip(F.lit(float("nan")), 0.0, 1.0))) and one(spark, numeric.clip(F.lit(7), 0, 5)) == 5


def test_softmax_is_stable(spark):
    got = one(spark, arrays.softmax(lit_array([1000.0, 1001.0])))
    assert got == pytest.approx([1 / (1 + math.e), math.e / (1 + math.e)]) and sum(got) == pytest.approx(1.0)


def test_keyed_random_numbers_do_not_depend_on_the_layout(spark):
    keys = spark.range(0, 5000)
    draw = lambda df: {r["id"]: (r["u"], r["z"]) for r in df.select("id", random.keyed_uniform(6, "id").alias("u"), random.keyed_normal(6, "id").alias("z")).collect()}
    first, second = draw(keys.repartition(3)), draw(keys.repartition(7))
    assert first == second
    u, z = [v[0] for v in first.values()], [v[1] for v in first.values()]
    assert abs(sum(u) / len(u) - 0.5) < 0.02 and abs(sum(z) / len(z)) < 0.05
    assert abs(sum(x * x for x in z) / len(z) - 1) < 0.08
    below = keys.where(random.keyed_below(6, 0.3, "id")).select("id").collect()
    assert {r["id"] for r in below} == {k for k, v in first.items() if v[0] < 0.3}
    assert random.share_limit(1.0) == "g" and random.share_limit(0.0) == "00000000"

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from offer_engine.functions import exact
from offer_engine.operators import attribution


def total(spark, values, parts=3):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return df.agg(exact.exact_sum(F.col("x")).alias("s")).first().s


CASES = {
    "cents": [round(random.Random(1).random() * 500, 2) for _ in range(3000)],
    "five decimals": [round(random.Random(2).gauss(0, 3), 5) for _ in range(3000)],
    "far apart": [1e15, 0.01, -1e15, 0.02, 1e15, 3.3, 1e-5] * 50,
    "cancelling": [0.1, 0.2, -0.3, 1e18, -1e18] * 40,
}


@pytest.mark.parametrize("name", CASES)
def test_equal_bits_in_any_order(spark, name):
    values = CASES[name]
    shuffled = random.Random(7).sample(values, len(values))
    got = {total(spark, values, 1), total(spark, values, 7), total(spark, shuffled, 5)}
    assert len(got) == 1
    true = float(sum(map(Fraction, values)))
    assert math.isclose(got.pop(), true, rel_tol=1e-15, abs_tol=1e-15)


def test_special_values(spark):
    assert math.isnan(total(spark, [1.0, math.nan, 2.0]))
    assert total(spark, [1.0, math.inf]) == math.inf
    assert math.isnan(total(spark, [math.inf, -math.inf, 1.0]))
    assert total(spark, [1e300, 1e300, 5.0]) == 2e300
    assert total(spark, [None, 2.5, None]) == 2.5
    assert total(spark, [None]) is None
    assert total(spark, []) is None
    assert total(spark, [-0.0, 0.0]) == 0.0


def test_sums_of_sums_and_windows_are_the_same(spark):
    rng = random.Random(3)
    rows = [(i % 11, i % 3, round(rng.random() * 1000, 2)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g int, h int, x double")
    parts = df.groupBy("g", "h").agg(exact.sum_of(F.col("x")).alias("p"))
    merged = parts.groupBy("h").agg(exact.total(exact.merged(F.col("p"))).alias("s"))
    window = Window.partitionBy("h")
    spread = parts.withColumn("w", exact.merged(F.col("p"), window)).select("h", exact.total(F.col("w")).alias("s"))
    plain = df.groupBy("h").agg(exact.exact_sum(F.col("x")).alias("s"))
    over = df.select("h", exact.exact_sum(F.col("x"), window).alias("s"))
    results = [{tuple(r) for r in d.select("h", "s").collect()} for d in (merged, spread, plain, over)]
    assert results[0] == results[1] == results[2] == results[3] and len(results[0]) == 3


def test_spend_does_not_depend_on_partitions(spark):
    rng = random.Random(5)
    rows = [(f"a{i % 5}", "transaction", round(rng.random() * 90, 2)) for i in range(4000)]
    events = spark.createDataFrame(rows, "account_id string, event string, amount double")
    one, many = (
        {tuple(r) for r in attribution.user_spend_stats(events.repartition(n)).collect()} for n in (1, 9)
    )
    assert one == many

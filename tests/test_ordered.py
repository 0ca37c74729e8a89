import hashlib
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from offer_engine.operators import ordered


def hash_of(value):
    return int(hashlib.md5(str(value).encode()).hexdigest()[:8], 16)


def table(spark, rows):
    return spark.createDataFrame(rows, "id string, score double, y double")


def make_rows(n, kind, seed=0):
    random.seed(seed)
    scores = {
        "spread": lambda i: random.gauss(0, 1),
        "half tied": lambda i: 0.0 if i % 2 else random.random(),
        "all tied": lambda i: 5.0,
        "few values": lambda i: float(random.randrange(4)),
        "special": lambda i: random.choice(
            [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 1.5, random.random()]
        ),
    }[kind]
    return [(f"k{i}", scores(i), round(random.random() * 100, 2)) for i in range(n)]


def order_key(descending):
    def key(row):
        ident, score, _ = row
        # NaN is above every number; nulls are below.
        level = 0 if score is None else 2 if math.isnan(score) else 1
        value = score if level == 1 else 0.0
        sign = -1 if descending else 1
        return (sign * level, sign * value, hash_of(ident), ident)

    return key


@pytest.mark.parametrize("kind", ["spread", "half tied", "all tied", "few values", "special"])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_is_the_global_order(spark, kind, descending):
    rows = make_rows(2000, kind)
    out = ordered.global_rank(
        table(spark, rows).repartition(7), "score", "id", descending=descending, buckets=16,
        tie_slices=8,
    )
    got = {r.id: r["rank"] for r in out.collect()}
    expected = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=order_key(descending)))}
    assert got == expected


@pytest.mark.parametrize("buckets,tie_slices", [(2, 1), (16, 8), (1024, 256)])
def test_running_sums_do_not_depend_on_the_buckets(spark, buckets, tie_slices):
    rows = make_rows(1500, "half tied", seed=2)
    out = ordered.running_sums(
        table(spark, rows), "score", "id", {"total": F.col("y").cast("decimal(18,4)"), "n": F.lit(1)},
        buckets=buckets, tie_slices=tie_slices,
    )
    total, expected = Decimal(0), {}
    for i, row in enumerate(sorted(rows, key=order_key(True))):
        total += Decimal(str(row[2]))
        expected[row[0]] = (i + 1, total, i + 1)
    assert {r.id: (r["rank"], r.total, r.n) for r in out.collect()} == expected


def test_a_value_held_by_most_rows_is_spread_over_buckets(spark):
    rows = [(f"k{i}", 0.0 if i % 4 else float(i), 1.0) for i in range(8000)]
    placed = ordered.into_buckets(table(spark, rows), "score", "id", buckets=64, tie_slices=32)
    largest = placed.offsets().agg(F.max("_size")).first()[0]
    assert largest < 8000 / 16


def test_no_row_level_window_without_partition(spark):
    df = table(spark, make_rows(500, "spread"))
    placed = ordered.into_buckets(df, "score", "id")
    plan = placed.ranked(placed.offsets())._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    # Only the bucket table goes to one task.
    assert len(single) == 1


def test_empty_and_single_row(spark):
    assert ordered.global_rank(table(spark, []), "score", "id").count() == 0
    one = ordered.global_rank(table(spark, [("a", None, 1.0)]), "score", "id").collect()
    assert [r["rank"] for r in one] == [1]


def test_integer_scores(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("c", 2)], "id string, score int")
    got = {r.id: r["rank"] for r in ordered.global_rank(df, "score", "id").collect()}
    assert got == {"a": 1, "c": 2, "b": 3}


def test_value_at_ranks_only_sorts_the_buckets_it_needs(spark):
    rows = make_rows(3000, "spread", seed=5)
    out = ordered.value_at_ranks(
        table(spark, rows), "score", "id", {"lo": 0.1, "hi": 0.9}, "q", "v", buckets=32
    )
    scores = sorted(r[1] for r in rows)
    assert {r.q: r.v for r in out.collect()} == {
        "lo": scores[math.ceil(0.1 * 3000) - 1], "hi": scores[math.ceil(0.9 * 3000) - 1]
    }


@pytest.mark.parametrize("descending", [True, False])
def test_no_bucket_above_the_bound(spark, descending):
    random.seed(4)
    scores = [math.inf if i % 3 == 0 else 7.5 if i % 5 == 0 else random.gauss(0, 1) for i in range(6000)]
    rows = [(f"k{i}", s, 1.0) for i, s in enumerate(scores)]
    df = table(spark, rows)
    options = {"descending": descending, "buckets": 4, "tie_slices": 2, "bucket_rows": 60}
    placed = ordered.into_buckets(df, "score", "id", **options)
    assert placed.offsets().agg(F.max("_size")).first()[0] <= 60
    got = {r.id: r["rank"] for r in ordered.global_rank(df, "score", "id", **options).collect()}
    assert got == {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=order_key(descending)))}

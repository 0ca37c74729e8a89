import random

import pytest
from pyspark.sql import functions as F

from fixtures import interactions, rows_of
from offer_engine.config import NO_OFFER_ID, TIME
from offer_engine.operators import attribution, ingest, skew
from offer_engine.operators.skew import EVEN, LogSkew, measure_skew

SCHEMA = (
    "event_id long, account_id string, event string, time_since_test_start double, "
    "offer_id string, amount double, reward double"
)


def events(spark):
    return ingest.flatten_interactions(interactions(spark))


def brute_force(rows):
    """event_id -> offer after looking one row back inside (account, time)."""
    groups = {}
    for row in rows:
        groups.setdefault((row[1], row[3]), []).append(row)
    filled = {}
    for group in groups.values():
        previous = None
        for row in sorted(group, key=lambda r: (r[2], r[0])):
            filled[row[0]] = row[4] if row[4] is not None else previous
            previous = row[4]
    return filled


def skewed_log(n=3000, seed=3):
    """A third of the rows is one account, most of them at one instant."""
    random.seed(seed)
    names = ["offer completed", "offer received", "offer viewed", "transaction"]
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        account = "hot" if hot else f"a{random.randrange(200)}"
        time = 1.0 if hot and i % 12 else float(random.randrange(5))
        event = random.choice(names)
        offer = None if event == "transaction" or random.random() < 0.3 else f"o{i % 7}"
        rows.append((i, account, event, time, offer, 1.5, None))
    random.shuffle(rows)
    return rows


def test_only_the_next_row_takes_the_offer(spark):
    got = dict(rows_of(attribution.attribute_offers(events(spark)), "event_id", "offer_id"))
    assert got[4] == "o1" and got[5] is None
    assert got[8] == "o5"
    assert got[9] is None and got[13] is None


def test_all_columns_and_rows_stay(spark):
    raw = events(spark)
    out = attribution.attribute_offers(raw)
    assert out.columns == raw.columns
    assert rows_of(out.drop("offer_id")) == rows_of(raw.drop("offer_id"))


def test_even_log_is_shuffled_once(spark):
    filled = attribution.attribute_offers(events(spark), skew=EVEN)
    plan = attribution.offer_events(filled)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_measure_skew_finds_the_heavy_keys(spark):
    df = spark.createDataFrame(skewed_log(), SCHEMA)
    skew = measure_skew(df, heavy_rows=300, heavy_share=0.01)
    assert len(skew.accounts) == 1 and len(skew.instants) == 1
    heavy = df.filter(skew.heavy_account())
    assert {r.account_id for r in heavy.collect()} == {"hot"}
    instant = {(r.account_id, r[TIME]) for r in df.filter(skew.heavy_instant()).collect()}
    assert instant == {("hot", 1.0)}
    assert measure_skew(df, heavy_rows=2000) == LogSkew(heavy_rows=2000)
    assert measure_skew(df.limit(0)).accounts == ()


@pytest.mark.parametrize(
    "heavy_rows,slices", [(300, 4), (100, 16), (20, 64), (2, 100), (1, 1024), (10**6, 4)]
)
def test_sliced_instants_give_the_same_result(spark, heavy_rows, slices):
    rows = skewed_log()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    skew = measure_skew(df, heavy_rows=heavy_rows, heavy_share=0.0)
    out = attribution.attribute_offers(df, skew=skew, slices=slices)
    assert dict(rows_of(out, "event_id", "offer_id")) == brute_force(rows)
    assert out.columns == df.columns


def test_heavy_account_without_a_heavy_instant(spark):
    rows = [r[:3] + (float(r[0] % 50),) + r[4:] for r in skewed_log()]
    df = spark.createDataFrame(rows, SCHEMA)
    skew = measure_skew(df, heavy_rows=500, heavy_share=0.0)
    assert skew.accounts and not skew.instants
    out = attribution.attribute_offers(df, skew=skew)
    assert dict(rows_of(out, "event_id", "offer_id")) == brute_force(rows)


def test_null_account_and_time_can_be_heavy(spark):
    rows = [r[:1] + (None,) + r[2:3] + (None,) + r[4:] for r in skewed_log(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    skew = measure_skew(df, heavy_rows=50, heavy_share=0.0)
    assert skew.instants
    out = attribution.attribute_offers(df, skew=skew, slices=8)
    assert dict(rows_of(out, "event_id", "offer_id")) == brute_force(rows)


def test_extract_transactions(spark):
    out = attribution.extract_transactions(events(spark))
    assert out.columns == ["account_id", "event", TIME, "offer_id", "amount", "reward"]


def test_offer_events(spark):
    out = attribution.offer_events(attribution.attribute_offers(events(spark)))
    got = {(r.account_id, r.offer_id): r for r in out.collect()}
    a1 = got["a1", "o1"]
    assert (a1.cnt_received, a1.cnt_viewed, a1.cnt_completed) == (1, 1, 1)
    assert a1.is_converted_valid == 1
    assert got["a6", "o1"].is_converted_valid == 0
    assert ("a1", NO_OFFER_ID) in got and ("a3", "missing") in got


def test_user_spend_stats(spark):
    got = {r.account_id: r for r in attribution.user_spend_stats(events(spark)).collect()}
    assert set(got) == {"a1", "a2", "a3"}
    assert (got["a1"].total_transactions, got["a1"].total_spent) == (2, 30.0)
    assert (got["a1"].avg_ticket, got["a1"].max_spent) == (15.0, 20.5)
    assert got["a2"].total_transactions == 1


def test_spend_of_only_null_amounts(spark):
    df = spark.createDataFrame([(1, "a", "transaction", 0.0, None, None, None)], SCHEMA)
    row = attribution.user_spend_stats(df).first()
    assert row.total_transactions == 0 and row.total_spent is None and row.avg_ticket is None


@pytest.mark.parametrize(
    "amounts", [[0.00004] * 1000, [1e15, 0.25], [10.0, float("nan")], [1.0, float("inf")]]
)
def test_spend_is_what_double_arithmetic_gives(spark, amounts):
    rows = [(i, "a", "transaction", 1.0, None, x, None) for i, x in enumerate(amounts)]
    got = attribution.user_spend_stats(spark.createDataFrame(rows, SCHEMA).repartition(3)).first()
    assert got.total_transactions == len(amounts)
    assert got.total_spent == pytest.approx(sum(amounts), nan_ok=True)
    assert got.avg_ticket == pytest.approx(sum(amounts) / len(amounts), nan_ok=True)


def test_tasks_grow_with_the_log(spark, monkeypatch):
    """Small partitions of a large log are not joined until a task's share grows with the log."""
    df = spark.range(4000).select(
        (F.col("id") % 500).cast("string").alias("account_id"), F.col("id").alias("event_id")
    )
    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    measured = measure_skew(df)
    assert measured.rows == 4000 and measured == EVEN
    placed = skew.place_by_account(df, measured)
    rows = [r["n"] for r in placed.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(rows) > 30 and sum(rows) == 4000
    of = placed.select("account_id", F.spark_partition_id().alias("p")).distinct()
    assert of.count() == 500

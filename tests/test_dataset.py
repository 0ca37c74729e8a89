import pytest

from fixtures import AS_OF, interactions, offers, profile, rows_of
from offer_engine.operators import attribution, dataset, ingest
from offer_engine.operators.skew import measure_skew
from offer_engine.plans import campaign


def inputs(spark):
    return (
        ingest.flatten_interactions(interactions(spark)),
        ingest.clean_profile(profile(spark), AS_OF),
        ingest.explode_channels(offers(spark)),
    )


def by_joins(events, profiles, offer_rows):
    """The training table in the plain form: two aggregates and three joins."""
    filled = attribution.attribute_offers(events)
    return dataset.join_dataset(
        attribution.offer_events(filled),
        profiles,
        ingest.channel_flags(offer_rows),
        attribution.user_spend_stats(filled),
    )


def test_one_pass_equals_the_joins(spark):
    events, profiles, offer_rows = inputs(spark)
    one_pass = campaign.consolidated(events, profiles, offer_rows)
    joined = by_joins(events, profiles, offer_rows)
    assert set(one_pass.columns) == set(joined.columns)
    assert rows_of(one_pass, *joined.columns) == rows_of(joined)


def test_rows_repeat_once_per_channel(spark):
    table = campaign.consolidated(*inputs(spark)).collect()
    count = lambda account, offer: sum(
        r.account_id == account and r.offer_id == offer for r in table
    )
    assert count("a1", "o1") == 4
    assert count("a1", "o2") == 1
    assert count("a3", "missing") == 1
    # An offer without channels has no row to join, but its events stay.
    assert count("a4", "o3") == 1


def test_per_offer_form_has_one_row_per_pair(spark):
    events, profiles, _ = inputs(spark)
    table = campaign.consolidated(events, profiles, ingest.per_offer(offers(spark)))
    pairs = rows_of(table, "account_id", "offer_id")
    assert len(pairs) == len(set(pairs))
    row = table.filter("account_id = 'a1' and offer_id = 'o1'").first()
    assert (row.has_web, row.has_email, row.has_mobile, row.has_social) == (1, 1, 1, 1)


def test_accounts_without_profile_drop_out_and_without_payments_get_zeros(spark):
    table = campaign.consolidated(*inputs(spark))
    accounts = {r.account_id for r in table.select("account_id").collect()}
    assert accounts == {"a1", "a2", "a3", "a4", "a6"}
    a6 = table.filter("account_id = 'a6'").first()
    assert (a6.total_transactions, a6.total_spent, a6.avg_ticket, a6.max_spent) == (0, 0.0, 0.0, 0.0)


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_result_does_not_depend_on_partitions_or_skew(spark, partitions):
    events, profiles, offer_rows = inputs(spark)
    expected = rows_of(campaign.consolidated(events, profiles, offer_rows))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        skew = measure_skew(events, heavy_rows=2, heavy_share=0.0)
        got = campaign.consolidated(events.repartition(3), profiles, offer_rows, skew)
        assert rows_of(got) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_enriched_events_keep_event_grain(spark):
    events, profiles, _ = inputs(spark)
    filled = attribution.attribute_offers(events)
    out = dataset.enriched_events(filled, profiles, ingest.per_offer(offers(spark)))
    ids = [r.event_id for r in out.collect()]
    assert sorted(ids) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 17, 18, 19, 20]
    first = out.filter("event_id = 1").first()
    assert first.channels == ["web", "email", "mobile", "social"] and first.age == 17
    assert out.filter("event_id = 11").first().offer_type is None


def test_empty_log(spark):
    events, profiles, offer_rows = inputs(spark)
    assert campaign.consolidated(events.limit(0), profiles, offer_rows).count() == 0


def test_a_counted_dimension(spark):
    rows = spark.createDataFrame(
        [(i, None if i % 3 == 0 else "no offer" if i % 3 == 1 else str(i % 7)) for i in range(60)],
        "account_id int, offer_id string",
    )
    offers = spark.createDataFrame([(str(i), f"t{i}") for i in range(5)], "offer_id string, offer_type string")
    few, many = dataset.with_dimension(rows, offers), dataset.with_dimension(rows, offers, few=2)
    assert sorted(map(str, few.collect())) == sorted(map(str, many.select(*few.columns).collect()))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(offer_id" not in plan
    assert few.filter("offer_type is not null").count() == sum(
        1 for r in rows.collect() if r.offer_id in {"0", "1", "2", "3", "4"}
    )


def test_only_rows_with_an_offer_are_shuffled_by_it(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "no offer"), (2, "a")], "account_id int, offer_id string")
    offers = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "offer_id string, offer_type string")
    many = dataset.with_dimension(rows, offers, few=2)
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    kept = [line for line in plan.splitlines() if "Filter" in line]
    assert any("NOT" in line and "no offer" in line for line in kept)
    assert any("isnull" in line and "no offer" in line for line in kept)


def test_a_popular_offer_is_not_sorted(spark):
    """Beyond few offers, each task holds its offers, and their rows pass through it."""
    rows = spark.createDataFrame([(i, "o1" if i % 5 else f"o{i}") for i in range(50)], "n int, offer_id string")
    offers = spark.createDataFrame([(f"o{i}", i) for i in range(0, 30)], "offer_id string, cost int")
    joined = dataset.with_dimension(rows, offers, few=3)
    assert "ShuffledHashJoin" in joined._jdf.queryExecution().sparkPlan().toString()
    want = {(i, 1 if i % 5 else (i if i < 30 else None)) for i in range(50)}
    assert {(r.n, r.cost) for r in joined.collect()} == want

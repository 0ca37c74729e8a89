import datetime as dt

import pytest

from fixtures import AS_OF, interactions, offers, profile, rows_of
from offer_engine import schemas
from offer_engine.operators import ingest


def test_explode_channels_gives_a_row_per_channel(spark):
    out = ingest.explode_channels(offers(spark))
    assert rows_of(out, "offer_id", "channels") == [
        ("o1", "email"),
        ("o1", "mobile"),
        ("o1", "social"),
        ("o1", "web"),
        ("o2", "web"),
        ("o5", "email"),
        ("o5", "social"),
    ]


def test_flags_of_exploded_rows_have_one_channel_each(spark):
    out = ingest.channel_flags(ingest.explode_channels(offers(spark)))
    assert "channels" not in out.columns
    for row in out.collect():
        assert row.has_web + row.has_email + row.has_mobile + row.has_social == 1


def test_flags_per_offer(spark):
    out = ingest.channel_flags(ingest.per_offer(offers(spark)))
    flags = rows_of(out, "offer_id", "has_web", "has_email", "has_mobile", "has_social")
    assert flags == [
        ("o1", 1, 1, 1, 1),
        ("o2", 1, 0, 0, 0),
        ("o3", 0, 0, 0, 0),
        ("o4", None, None, None, None),
        ("o5", 0, 1, 0, 1),
    ]


def test_clean_profile(spark):
    out = ingest.clean_profile(profile(spark), AS_OF)
    got = {r.account_id: r for r in out.collect()}
    assert set(got) == {"a1", "a2", "a3", "a4", "a6", "a7"}
    assert got["a1"].registered_on == dt.date(2017, 1, 1)
    assert got["a1"].registered_on_days == (AS_OF - dt.date(2017, 1, 1)).days
    assert got["a3"].registered_on is None and got["a3"].registered_on_days is None
    assert got["a7"].registered_on_days == 0


def test_clean_profile_takes_numbers_and_renames_a_foreign_offer_id(spark):
    raw = spark.createDataFrame(
        [("a", 20170305, "F", "o1")], "id string, registered_on long, gender string, offer_id string"
    )
    out = ingest.clean_profile(raw)
    row = out.first()
    assert row.registered_on == dt.date(2017, 3, 5) and row.offer_id_user == "o1"
    assert row.registered_on_days == (spark.sql("select current_date()").first()[0] - row.registered_on).days


def test_flatten_follows_the_fields_of_the_struct(spark):
    df = spark.createDataFrame([("a", (1, "x y"))], "account_id string, value struct<`n m`:int,s:string>")
    assert ingest.flatten_value(df).columns == ["account_id", "n m", "s"]


def test_merge_offer_id(spark):
    out = ingest.flatten_interactions(interactions(spark))
    assert "offer id" not in out.columns and "value" not in out.columns
    ids = dict(rows_of(out, "event_id", "offer_id"))
    assert ids[1] == "o1" and ids[3] == "o1" and ids[6] == "o2" and ids[4] is None


def test_merge_offer_id_without_the_second_spelling(spark):
    df = spark.createDataFrame([("a", "o1")], "account_id string, offer_id string")
    assert ingest.merge_offer_id(df).collect() == df.collect()
    only = spark.createDataFrame([("a", "o1")], "account_id string, `offer id` string")
    assert ingest.merge_offer_id(only).columns == ["account_id", "offer_id"]


def test_number_rows_keeps_existing_numbers(spark):
    events = ingest.flatten_interactions(interactions(spark))
    assert rows_of(ingest.number_rows(events), "event_id") == rows_of(events, "event_id")
    bare = events.drop("event_id")
    assert ingest.number_rows(bare).select("event_id").distinct().count() == events.count()


@pytest.mark.parametrize("schema", [None, schemas.OFFERS])
def test_empty_input(spark, schema):
    empty = spark.createDataFrame([], schemas.OFFERS)
    assert ingest.explode_channels(empty).count() == 0

"""The composite job from JSON files, also for a log without row numbers."""

import json
from pathlib import Path

import pytest

from fixtures import AS_OF, interactions, offers, profile, rows_of
from offer_engine import config as C
from offer_engine import schemas
from offer_engine.plans import campaign
from offer_engine.sources import tables


@pytest.fixture
def raw(spark, tmp_path):
    offers(spark).write.json(str(tmp_path / "offers"))
    profile(spark).write.json(str(tmp_path / "profile"))
    interactions(spark).write.json(str(tmp_path / "transactions"))
    return tmp_path


@pytest.fixture
def names(spark, tmp_path):
    names = C.TableNames(schema=f"campaign_{tmp_path.name.replace('-', '_')}")
    tables.create_namespace(spark, names, str(tmp_path / "warehouse"))
    yield names
    spark.sql(f"DROP DATABASE {names.namespace} CASCADE")


def test_ingested_tables(spark, raw, names):
    per_channel = campaign.ingest_offers(spark, str(raw / "offers"), names)
    assert per_channel.count() == 7
    per_offer = campaign.ingest_offers(spark, str(raw / "offers"), names, "per_offer")
    assert per_offer.count() == 5
    profiles = campaign.ingest_profile(spark, str(raw / "profile"), names, AS_OF)
    assert profiles.count() == 6
    events = campaign.ingest_transactions(spark, str(raw / "transactions"), names)
    assert "event_id" in events.columns and events.count() == 20
    assert events.select("event_id").distinct().count() == 20
    for table in ("offers", "profile", "transactions"):
        assert tables.read_table(spark, names.qualified(table)).count() > 0


def test_log_with_one_offer_spelling(spark, tmp_path, names):
    line = {"account_id": "a", "event": "transaction", "time_since_test_start": 0,
            "value": {"amount": 3.5}}
    path = tmp_path / "log.json"
    path.write_text(json.dumps(line) + "\n")
    inferred = campaign.ingest_transactions(spark, str(path), names, schema=None)
    assert rows_of(inferred, "account_id", "amount") == [("a", 3.5)]


@pytest.mark.parametrize("mode", ["exploded", "per_offer"])
def test_campaign(spark, raw, names, mode):
    report = campaign.campaign(
        spark,
        *[str(raw / n) for n in ("offers", "profile", "transactions")],
        names=names,
        as_of=AS_OF,
        params=C.ForestParams(num_trees=2, max_depth=2),
        interaction_schema=schemas.NUMBERED_INTERACTIONS,
        channel_mode=mode,
    )
    rows = report.collect()
    assert {r.offer_type for r in rows} <= set(C.SEGMENTS)
    table = tables.read_table(spark, names.qualified("consolidated"))
    splits = tables.read_table(spark, names.qualified("splits"))
    assert splits.count() == table.count()
    assert set(splits.columns) >= {"offer_type", "split", *C.FEATURES}


def folders(spark):
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    return sorted(p.name for p in root.glob("offer_engine-*"))


def test_jobs_leave_no_scratch_behind(spark, raw, names):
    before = folders(spark)
    campaign.campaign(
        spark, *[str(raw / n) for n in ("offers", "profile", "transactions")], names=names, as_of=AS_OF,
        params=C.ForestParams(num_trees=2, max_depth=2),
    ).collect()
    assert folders(spark) == before


def test_scratch_goes_at_its_end_only(spark):
    before, databases = folders(spark), {d.name for d in spark.catalog.listDatabases()}
    with tables.scratch():
        inner = tables.store(spark.range(5), tables.shared_folder(spark))
        own = tables.temporary_names(spark)
        tables.save_table(spark.range(3), own.qualified("offers"))
        assert inner.count() == 5 and len(folders(spark)) == len(before) + 2
    assert folders(spark) == before
    assert {d.name for d in spark.catalog.listDatabases()} == databases


def test_customer_features_from_offers_in_either_shape(spark, raw, names):
    events = campaign.ingest_transactions(spark, str(raw / "transactions"), names)
    people = campaign.ingest_profile(spark, str(raw / "profile"), names, AS_OF)
    found = []
    for mode in ("exploded", "per_offer"):
        stored = campaign.ingest_offers(spark, str(raw / "offers"), names, mode)
        table = campaign.customer_features(events, people, stored)
        found.append(sorted(map(str, table.collect())))
        stored = None
    assert found[0] == found[1] and found[0]


def test_report_has_segments_without_a_model(spark, raw, names, monkeypatch):
    fit = campaign.forest.train_segments
    monkeypatch.setattr(
        campaign.forest, "train_segments", lambda v, s, p: {k: m for k, m in fit(v, s, p).items() if k != "bogo"}
    )
    report = campaign.campaign(
        spark, *[str(raw / n) for n in ("offers", "profile", "transactions")], names=names, as_of=AS_OF,
        params=C.ForestParams(num_trees=2, max_depth=2),
    )
    lines = {r.offer_type: r for r in report.collect()}
    assert lines["bogo"].accounts > 0 and lines["bogo"].model_version is None and lines["bogo"].mae is None

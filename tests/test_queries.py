"""Every registered query against its SQL, on the smallest tables."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from offer_engine.config import ForestParams

SF = "/root/testdata/sf0.001"
# Queries of parts that can be taken out have tests of their own.
QUERIES = {k: q for k, q in registry.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
ORACLE = {k: q for k, q in registry.oracle_sql().items() if k in QUERIES}
FORESTS = (
    "train_forest", "train_segments", "model_runs", "evaluate_saved", "recorded_sample", "tlearner_score",
    "campaign_report",
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(columns), sorted(picked, key=lambda r: tuple((v is not None, repr(v)) for v in r))


def test_every_query_has_sql():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, monkeypatch, name):
    sql = ORACLE[name]
    if name in FORESTS:  # smaller forests, as the values don't depend on their size
        monkeypatch.setattr(registry, "FOREST", ForestParams(num_trees=3, max_depth=3))
        sql = sql.replace("100 AS num_trees", "3 AS num_trees").replace("15 AS max", "3 AS max")
    df = QUERIES[name](spark, SF)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    relation = duck.execute(sql)
    columns = [c[0] for c in relation.description]
    assert got == canonical(columns, relation.fetchall())


def test_entry(spark):
    assert registry.entry(spark).count() > 0


def test_explicit_broadcasts_hold_bounded_tables_only():
    """Broadcast hints: the tables of buckets and of cuts in ordered.py, the cut points of heavy
    instants, and offers after they have been counted."""
    root = Path(registry.__file__).parent / "offer_engine"
    own = [p for p in root.rglob("*.py") if p.parent.name != "llm"]
    hinted = {p.name for p in own if "F.broadcast(" in p.read_text()}
    assert hinted == {"ordered.py", "attribution.py", "dataset.py"}

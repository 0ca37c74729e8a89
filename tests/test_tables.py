import json
from types import SimpleNamespace

import pytest

from fixtures import OFFER_ROWS, offers, rows_of
from offer_engine import config as C
from offer_engine import schemas
from offer_engine.sources import tables


def test_json_lines_with_and_without_schema(spark, tmp_path):
    path = str(tmp_path / "lines")
    offers(spark).write.json(path)
    given = tables.read_json(spark, path, schemas.OFFERS)
    assert rows_of(given, "id") == rows_of(offers(spark), "id")
    inferred = tables.read_json(spark, path)
    assert set(inferred.columns) == set(given.columns)


def test_json_array_on_one_line(spark, tmp_path):
    path = tmp_path / "offers.json"
    names = schemas.OFFERS.fieldNames()
    path.write_text(json.dumps([dict(zip(names, row)) for row in OFFER_ROWS]))
    got = tables.read_json(spark, str(path), schemas.OFFERS)
    assert rows_of(got) == rows_of(offers(spark))


def test_save_replaces_rows_and_schema(spark):
    names = C.TableNames(schema="tables_test")
    tables.create_namespace(spark, names)
    tables.create_namespace(spark, names)
    name = names.qualified("offers")
    tables.save_table(offers(spark), name)
    out = tables.save_table(spark.range(3), name)
    assert out.columns == ["id"] and tables.read_table(spark, name).count() == 3
    tables.save_table(spark.range(2), name, mode="append")
    assert tables.read_table(spark, name).count() == 5
    spark.sql("DROP DATABASE tables_test CASCADE")


def test_names():
    assert C.TableNames().qualified("consolidated") == "default.data_processing"
    assert C.TableNames("s", "c").qualified("offers") == "c.s.offers"


def test_shared_folder_follows_the_checkpoint_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = tables.shared_folder(spark), tables.shared_folder(spark)
    assert one.startswith(root) and one != two


def test_no_local_folder_on_a_cluster():
    cluster = SimpleNamespace(
        conf={}, sparkContext=SimpleNamespace(master="spark://host:7077")
    )
    with pytest.raises(ValueError):
        tables.shared_folder(cluster)


def test_store_keeps_rows_and_cuts_the_plan(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 2 AS side")
    out = tables.store(df, str(tmp_path / "x"))
    assert rows_of(out) == rows_of(df)
    assert "Range" not in out._jdf.queryExecution().executedPlan().toString()


def test_store_of_no_rows(spark, tmp_path):
    df = spark.range(0).selectExpr("id", "'a' AS side")
    assert tables.store(df, str(tmp_path / "x"), ("side",)).count() == 0


@pytest.mark.parametrize("rows", [[], [(1, "a")]])
def test_empty_table(spark, rows):
    schema = spark.createDataFrame([(1, "a")], "x int, y string").schema
    assert tables.empty_table(spark, schema).schema == schema

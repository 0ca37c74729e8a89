from fixtures import rows_of
from offer_engine import config as C
from offer_engine.operators import split
from offer_engine.sources.tables import save_table, store


def accounts(spark, n=2000):
    rows = [(f"a{i % 500}", C.SEGMENTS[i % 4], i) for i in range(n)]
    return spark.createDataFrame(rows, "account_id string, offer_type string, n int")


def test_split_is_complete_and_disjoint_by_account(spark):
    out = split.assign_split(accounts(spark))
    assert out.count() == 2000
    sides = {}
    for row in out.collect():
        sides.setdefault(row.account_id, set()).add(row.split)
    assert all(len(s) == 1 for s in sides.values())
    train = sum(s == {"train"} for s in sides.values())
    assert 0.75 < train / len(sides) < 0.85


def test_split_follows_seed_and_ratio_not_partitions(spark):
    df = accounts(spark)
    one = rows_of(split.assign_split(df.repartition(1)))
    assert one == rows_of(split.assign_split(df.repartition(9)))
    assert one != rows_of(split.assign_split(df, seed=43))
    assert split.assign_split(df, train_ratio=1.0).filter("split = 'test'").count() == 0
    assert split.assign_split(df, train_ratio=0.0).filter("split = 'train'").count() == 0


def test_random_split(spark):
    train, test = split.random_split(accounts(spark))
    assert train.count() + test.count() == 2000


def test_union_of_test_sides(spark):
    out = split.assign_split(accounts(spark))
    assert rows_of(split.test_rows(out)) == rows_of(out.filter("split = 'test'"))


def test_union_of_nothing_keeps_the_schema(spark):
    df = accounts(spark)
    empty = split.union_all([], df.schema, spark)
    assert empty.schema == df.schema and empty.count() == 0


def test_partitioned_sides_are_pruned(spark, tmp_path):
    stored = store(
        split.assign_split(accounts(spark)), str(tmp_path / "s"), ("offer_type", "split")
    )
    bogo = split.segment_rows(stored, "bogo", "test")
    assert len(bogo.inputFiles()) < len(stored.inputFiles()) or "PartitionFilters: [isnotnull" in (
        bogo._jdf.queryExecution().executedPlan().toString()
    )
    assert stored.count() == 2000


def test_one_row_per_key(spark):
    df = accounts(spark)
    out = split.one_row_per_key(df, ["account_id"], ["n"])
    assert {r.account_id: r.n for r in out.collect()} == {f"a{i}": i for i in range(500)}


def test_heavy_keys_are_reduced_before_the_shuffle(spark):
    out = split.one_row_per_key(accounts(spark), ["account_id"], ["n"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below


def test_distinct_accounts(spark):
    assert split.distinct_accounts(accounts(spark)).count() == 500


def test_save_table_partitioned(spark):
    out = save_table(
        split.assign_split(accounts(spark)), "splits_test", partition_by=("offer_type", "split")
    )
    assert out.count() == 2000
    assert len(out.filter("offer_type = 'bogo'").inputFiles()) > 0
    spark.sql("DROP TABLE splits_test")

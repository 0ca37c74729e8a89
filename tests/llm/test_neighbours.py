import numpy as np
import pytest
from pyspark.sql import functions as F

from offer_engine.llm import neighbours

KINDS = "vec_id long, embedding array<float>, label int"
def asks():
    return F.col("vec_id") % 20 == 0


def brute_force(rows, near=10):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for i, q in enumerate(ids):
        if q % 20 == 0:
            far = np.sqrt(((x - x[i]) ** 2).sum(1))
            order = [j for j in np.lexsort((ids, far)) if ids[j] != q][:near]
            out[int(q)] = [(int(ids[j]), far[j]) for j in order]
    return out


def found(df, **options):
    out = {}
    for r in neighbours.search(df, asks(), **options).orderBy("query_id", "rank").collect():
        got = out.setdefault(r.query_id, [])
        got.append((r.vec_id, r.score))
        assert r["rank"] == len(got)
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 16))
    x[500:800] = x[500]  # a hot leaf
    x[900:950] = x[850:900] + 0.001
    return [(i, v.tolist(), 0) for i, v in enumerate(x)]


def test_recall_against_brute_force(spark, vectors):
    df = spark.createDataFrame(vectors, KINDS)
    got, want = found(df, leaf_rows=40), brute_force(vectors)
    assert got.keys() == want.keys()
    hits = 0
    for q, w in want.items():
        assert len(got[q]) == 10
        limit = w[-1][1] + 1e-9
        hits += sum(s <= limit for _, s in got[q])
        x = {r[0]: np.array(r[1], np.float32).astype(float) for r in vectors if r[0] == q or r[0] in dict(got[q])}
        assert all(np.isclose(s, np.sqrt(((x[i] - x[q]) ** 2).sum()), rtol=1e-12) for i, s in got[q])
    assert hits / (10 * len(want)) >= 0.93


def test_hot_vector_gives_smallest_ids(spark, vectors):
    got = found(spark.createDataFrame(vectors, KINDS), leaf_rows=40)
    assert [i for i, _ in got[600]] == list(range(500, 510))


def test_few_candidates_are_all_returned(spark):
    rows = [(i, [float(i), 1.0], 0) for i in range(5)]
    assert found(spark.createDataFrame(rows, KINDS)) == brute_force(rows)


def test_edges(spark):
    rows = [
        (0, [1.0, 0.0], None),
        (1, [2.0, 0.0], None),
        (2, [0.0, 0.0], 1),
        (3, None, 1),
        (4, [1.0, None], 1),
        (5, [float("nan"), 1.0], 1),
        (6, [float("inf"), 1.0], 1),
        (7, [1.0, 2.0, 3.0], 1),
        (None, [1.0, 1.0], 1),
        (8, [], 1),
        (9, [3.0, 0.0], 1),
        (9, [2.5, 0.0], 1),
        (20, [0.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, KINDS).withColumns({"id": F.lit(1), "leaf": F.lit("x"), "vector": F.lit(2)})
    assert found(df) == {0: [(1, 1.0), (9, 1.5)]}


def test_empty(spark):
    assert found(spark.createDataFrame([], KINDS)) == {}
    assert found(spark.createDataFrame([(20, [0.0], 1)], KINDS)) == {}


def test_one_id_on_many_rows_leaves_room_for_the_others(spark):
    """An id with 50 rows near the query, and one with a third of all rows."""
    rng = np.random.default_rng(3)
    for copies, others in ((50, 28), (700, 1400)):
        query = np.ones(4)
        rows = [(0, query.tolist())]
        rows += [(1, (query + 0.001 * rng.standard_normal(4)).tolist()) for _ in range(copies)]
        rows += [(i, (query + 3 * rng.standard_normal(4)).tolist()) for i in range(2, 2 + others)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = neighbours.search(df, F.col("vec_id") == 0, leaf_rows=20, sample_rows=500).orderBy("rank").collect()
        assert len(got) == 10 and got[0].vec_id == 1 and len({r.vec_id for r in got}) == 10
        least = {}
        for i, v in rows[1:]:
            least[i] = min(least.get(i, np.inf), float(np.sqrt(((np.array(v) - query) ** 2).sum())))
        want = sorted(least, key=lambda i: (least[i], i))[:10]
        assert len({r.vec_id for r in got} & set(want)) >= 9

import hashlib
from collections import Counter, defaultdict

import pyarrow as pa

from offer_engine.llm import exact_dedup
from tests.llm.edges import edge_rows, table, words


def check(rows, got):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    assert len(got) == len(rows)
    kept = Counter()
    for r in got:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        ids = [i for i in groups[text] if i is not None]
        assert r.keep_id == max(ids, default=None)
        assert r.group_size == len(groups[text])
        assert r.doc_id == r.keep_id or not r.kept
        kept[text] += r.kept
    assert set(kept.values()) <= {1}


def test_like_brute_force_with_heavy_digests(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i % 500}", "en", "a", 0) for i in range(3000)]
    check(rows, exact_dedup.exact_dedup(table(spark, rows).repartition(5), columns=["doc_id"]).collect())


def test_edges_and_clashing_columns(spark):
    got = exact_dedup.exact_dedup(table(spark, edge_rows(), clashing=True))
    check(edge_rows(), got.collect())
    assert {r["digest"] for r in got.select("digest").collect()} == {"kept digest"}
    assert got.columns.count("text_sha256") == 1


def test_empty(spark):
    assert exact_dedup.exact_dedup(table(spark, [])).count() == 0
    assert exact_dedup.without_copies(table(spark, [])).count() == 0


def test_without_copies_keeps_one_row_of_each_text(spark):
    rows = edge_rows()
    got = exact_dedup.without_copies(table(spark, rows, clashing=True))
    assert sorted(r.text or "" for r in got.collect()) == sorted({r[1] or "" for r in rows})


def test_misra_gries_bounds():
    values = [b"a"] * 500 + [b"b"] * 300 + [words(i, 1, 10**6).encode() for i in range(1000)]
    batches = [
        pa.RecordBatch.from_pydict({"digest": pa.array(values[i::7], pa.binary())}) for i in range(7)
    ]
    (out,) = exact_dedup.misra_gries(iter(batches), counters=20)
    low = dict(zip(out["digest"].to_pylist(), out["low"].to_pylist(), strict=True))
    true = Counter(values)
    assert len(low) <= 20 and low[b"a"] > low[b"b"]
    for k, n in low.items():
        assert true[k] - len(values) / 21 <= n <= true[k]

import hashlib
import inspect
import random
import re
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from offer_engine.llm import passages, slots
from offer_engine.llm.queries import ORACLE, QUERIES
from tests.llm.edges import edge_rows, table, words

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window):
    least, split = {}, []
    for id_, text, *_ in rows:
        found = WORD.findall(text or "")
        split.append((id_, found))
        for i in range(len(found) - window + 1):
            span = tuple(found[i : i + window])
            if id_ is not None:
                least[span] = min(least.get(span, id_), id_)
    out = []
    for id_, found in split:
        gone = [False] * len(found)
        for i in range(len(found) - window + 1):
            if id_ is not None and least.get(tuple(found[i : i + window]), id_) < id_:
                gone[i : i + window] = [True] * window
        kept = " ".join(w for w, g in zip(found, gone, strict=True) if not g)
        out.append((id_, len(found), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


def planted(seed, n):
    """Documents that share passages of many lengths, some just below a window."""
    rng = random.Random(seed)
    passage = [words(1000 + i, rng.choice([9, 10, 11, 14, 19, 25, 60])).split() for i in range(12)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            parts += words(seed + rng.randrange(10**6), rng.randrange(0, 25), 60).split()
            if rng.random() < 0.7:
                p = rng.choice(passage)
                a = rng.randrange(0, 4)
                parts += p[a : len(p) - rng.randrange(0, 3)]
        text = "".join(w + rng.choice([" ", "  ", "\n", "\t "]) for w in parts)
        rows.append((rng.choice([i, i, i, 7, None]) if i % 9 == 0 else i, text, "en", "a", 0))
    return rows + rows[5:9]


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    rows = planted(seed, 150)
    got = passages.without_repeats(table(spark, rows).repartition(7), block=5, slot_bytes=2000, columns=["doc_id"])
    want = brute(rows, 10)
    assert found(got) == want
    assert sum(r[2] for r in want) > 500


def test_one_text_on_a_third_of_all_rows_and_a_common_passage(spark):
    common = words(5, 70)
    rows = [(1000 + i, common if i % 3 == 0 else f"{words(i, 30)} {common} {words(-i, 20)}", "en", "a", 0) for i in range(400)]
    got = passages.without_repeats(table(spark, rows).repartition(9), slot_bytes=5000, columns=["doc_id"])
    assert found(got) == brute(rows, 50)


def test_edges_and_clashing_columns(spark):
    rows = edge_rows() + [(11, words(1, 20_000, 5000), "en", "a", 0), (12, "x" * 3_000_000 + " end", "en", "a", 0)]
    got = passages.without_repeats(table(spark, rows, clashing=True))
    assert found(got) == brute(rows, 50)
    assert {r["digest"] for r in got.select("digest").collect()} == {"kept digest"}


def test_spans_cut_the_text(spark):
    rows = planted(3, 60)
    got = passages.without_repeats(table(spark, rows), block=5)
    for r in got.withColumn("kept", passages.kept_text(got["text"], got["spans"])).collect():
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
        assert all(s.length >= 10 for s in r.spans)


def test_empty(spark):
    assert passages.without_repeats(table(spark, [])).count() == 0


def test_words_are_hashed_alike_in_any_place(monkeypatch):
    text = (words(1, 3000, 40) + " ü漢字 " + "y" * 5000 + "\n\t" + words(2, 50, 40)).encode()
    starts, (one, two) = passages.word_hashes(text, 2)
    monkeypatch.setattr(passages, "PIECE", 64)
    again, (three, four) = passages.word_hashes(b" \n" + text, 2)
    split = text.split()
    assert (again - 2 == starts).all() and (one == three).all() and (two == four).all()
    assert len(split) == len(starts) == len(one)
    assert len(set(zip(split, one.tolist(), strict=True))) == len(set(split)) == len(set(one.tolist()))


def test_packed_numbers_come_back():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64))
    assert (slots.unpack_sorted(slots.pack_sorted(values), np.uint64) == values).all()
    assert (slots.unpack(slots.pack(values[::-1]), np.uint64) == values[::-1]).all()
    assert len(slots.unpack_sorted(slots.pack_sorted(values[:0]), np.uint64)) == 0


def test_query_like_brute_force_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = found(QUERIES["op12_passages"](spark, sf))
    assert got == brute(rows, 50)
    edge = edge_rows() + planted(8, 40) + [(i, words(77, 60), "", "", 0) for i in (30, 20, None)]
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in edge])
    assert sorted(con.sql(ORACLE["op12_passages"]).fetchall(), key=repr) == brute(edge, 50)


def test_a_slot_of_common_windows_takes_bounded_memory():
    size = inspect.signature(passages.repeats).parameters["slot_bytes"].default
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 123, 40_000, np.uint8) for _ in range(size // 40_000)]
    for t in texts:
        t[4::5] = 32
    texts = [t.tobytes().decode() for t in texts]
    kinds = [("digest", pa.binary()), ("id", pa.int64()), ("text", pa.string()), ("n", pa.int64())]
    columns = [[str(i).encode() for i in range(len(texts))], list(range(len(texts))), texts, [1] * len(texts)]
    slot = pa.table([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])
    asked = passages.asking(3, 25)((pa.scalar(0),), slot)
    blocks = [slots.unpack_sorted(b, np.uint32) for b in asked.column("blocks").to_pylist()]
    answers = {"slot": [0] * len(blocks), "bucket": asked.column("bucket").to_pylist(), "keys": [slots.pack_sorted(b) for b in blocks]}
    tracemalloc.start()
    windows = passages.extending(3, 25)((pa.scalar(0),), slot, slots.rows_of(answers, passages.ANCHORS))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(len(x) for x in windows.column("low").to_pylist()) // 8 > 0.9 * size / 5
    assert most < 250_000_000

"""Each registered query of the operators against its SQL, and the pipeline against plain Python."""

import random
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline
from offer_engine.llm import exact_dedup, near_duplicates
from offer_engine.llm.queries import ORACLE, QUERIES
from tests.llm.edges import edge_rows, table, words

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_like_sql(spark, name):
    got = QUERIES[name](spark, SF)
    names = sorted(got.columns)
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    want = con.sql(ORACLE[name]).select(*[f'"{n}"' for n in names]).fetchall()
    rounded = lambda rows: sorted(repr([round(x, 6) if isinstance(x, float) else x for x in r]) for r in rows)
    assert rounded(got.select(*names).collect()) == rounded(want)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_keep_the_columns_and_do_their_work(spark):
    rows = [(i, words(i % 40, 60, 3000), "en", "ab"[i % 2], 0) for i in range(100)]
    docs = table(spark, rows + edge_rows(), clashing=True)
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == names, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        texts = [r.text for r in docs.collect()]
        if name == "language_id":
            assert all(any(c.isalpha() for c in t or "") for t in texts)
        if name == "exact_dedup":
            assert len(texts) == len(set(texts))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}


def test_pipeline_ends_where_its_parts_do(spark):
    pieces = corpus_pipeline.run(spark, SF)
    got = {r.doc_id for r in pieces.select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    spoken = corpus_pipeline.language_id(spark, docs, SF)
    one = near_duplicates.one_of_each(exact_dedup.without_copies(spoken))
    assert got <= {r.doc_id for r in one.select("doc_id").collect()}
    assert len(corpus_pipeline.STAGES) == 5


def test_empty_pipeline(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_first_stage_keeps_clean_documents(spark):
    """Code-switched, short and held-out texts stay; junk goes. Without labels, words decide."""
    rng = random.Random(1)
    tongues = {k: [f"{k}{i}{k[::-1]}" for i in range(40)] for k in ("ab", "cd", "ef")}
    text = lambda k, n: " ".join(rng.choice(tongues[k]) for _ in range(n))
    rows = [(i, text(k, 40), k, "a", 0) for i in range(300) for k in [rng.choice(list(tongues))]]
    clean = [(1000 + i, f"{text('ab', 8)} {text('cd', 6)} {text('ef', 6)}", None, "a", 0) for i in range(20)]
    clean += [(1100 + i, text("ab", 1), None, "a", 0) for i in range(10)]
    junk = [(2000, "12 34 -- ## 5", "ab", "a", 0), (2001, "½ ² ①", "ab", "a", 0), (2002, None, "ab", "a", 0)]
    junk += [(2003, "= = = = x", "ab", "a", 0), (2004, "", "cd", "a", 0)]
    docs = table(spark, rows + clean + junk)
    wanted = {r[0] for r in rows + clean}
    assert {r.doc_id for r in corpus_pipeline.language_id(spark, docs, SF).collect()} == wanted
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in corpus_pipeline.language_id(spark, unlabelled, SF).collect()} == wanted


def test_language_found_decides_the_mix(spark):
    """A document without a language, or with another's, is dealt with those of the one found."""
    rng = random.Random(2)
    tongues = {k: [f"{k}{i}{k[::-1]}" for i in range(40)] for k in ("ab", "cd")}
    text = lambda k, n: " ".join(rng.choice(tongues[k]) for _ in range(n))
    rows = [(i, text(k, 40), k, "a", 0) for i in range(200) for k in [("ab", "cd")[i % 2]]]
    odd = [(1000 + i, text("cd", 40), None if i % 2 else "ab", "a", 0) for i in range(10)]
    docs = table(spark, rows + odd)
    found = corpus_pipeline.language_id(spark, docs, SF)
    langs = {r.doc_id: r.lang for r in found.collect()}
    assert all(langs[r[0]] == r[2] for r in rows) and all(langs[r[0]] == "cd" for r in odd)
    # ab weighs 3 and cd 1: with all documents of a source in one language, each share differs.
    mixed = lambda df: sorted(r.doc_id for r in corpus_pipeline.mix(spark, df, SF).collect())
    assert mixed(found) != mixed(docs)
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    assert mixed(corpus_pipeline.language_id(spark, unknown, SF)) == mixed(unknown)


def test_stages_remove_what_earlier_ones_stored(spark, tmp_path):
    docs = table(spark, [(i, words(i % 20, 60, 300), "en", "a", 0) for i in range(60)])
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    corpus_pipeline.exact(spark, table(spark, []), SF)
    before = {p.name for p in root.glob("offer_engine-*")}
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{n}")
        if n < len(corpus_pipeline.STAGES) - 1:
            docs = spark.read.parquet(f"{tmp_path}/{n}")
    corpus_pipeline.language_id(spark, table(spark, []), SF)
    assert len({p.name for p in root.glob("offer_engine-*")}) <= len(before)

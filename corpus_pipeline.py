"""A corpus pipeline of the operators in offer_engine.llm.

Each stage reads what the one before it kept, and all but the last return the columns of
documents. A field, tries and sums are worked out anew on each stage's own input.

What a stage stores for itself is removed when the next one starts, as its result has been written
by then; stages of one process run one after another.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offer_engine.llm import exact_dedup, language, mixing, near_duplicates, packing
from offer_engine.sources.tables import Scratch, remove_folder, shared_folder, store

#: Share of the runs of characters between white space that must hold a letter.
LEAST_WORDS = 0.5

_scratch = Scratch()


def stage(work):
    """A stage that first removes what the stage before it stored for itself."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _scratch.clear()
        with _scratch.collecting():
            return work(spark, docs, sf_dir)

    run.__name__, run.__doc__ = work.__name__, work.__doc__
    return run


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, at least half of whose words hold letters.

    Texts in several languages stay, however their words are shared out among these. lang is the
    language found, by which the mix deals. Where no document has a language to learn from, the
    words alone decide, and lang stays as it is."""
    names = docs.columns
    row = F.struct(*[F.col(f"`{n}`") for n in names]).alias("row")
    words = F.size(F.regexp_extract_all("text", F.lit(r"\S+"), F.lit(0)))
    spoken = F.size(F.regexp_extract_all("text", F.lit(r"(?>[^\s\p{L}]*)\p{L}\S*"), F.lit(0)))
    enough = (spoken > 0) & (spoken >= LEAST_WORDS * words)
    rows = docs.select(row, "text", "lang", "doc_id").withColumn("enough", enough)
    found = language.identify(rows, columns=["row", "enough"])
    learned = docs.filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (language.fold(F.col("doc_id"), 4) != 2)
    )
    known = F.col("lang_pred") != language.UNKNOWN
    kept = F.col("enough") & (F.lit(learned.isEmpty()) | known)
    given = {n: F.col("row").getField(n) for n in names}
    given["lang"] = F.when(known, F.col("lang_pred")).otherwise(given["lang"])
    return found.filter(kept).select(*[given[n].alias(n) for n in names])


@stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.without_copies(docs)


@stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_duplicates.one_of_each(docs)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, with weights for each source of each language."""
    dealt = docs.withColumn("__dealt", F.to_json(F.struct("lang", "source")))
    return mixing.mixed(dealt, source="__dealt").select(*[F.col(f"`{n}`") for n in docs.columns])


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences. A document that the mix took twice is packed twice."""
    return packing.with_checksum(
        packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    )


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("near_duplicates", near),
    ("mixing", mix),
    ("packing", pack),
]

#: Language identification, near-duplicate classes and packing can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, work in STAGES[:-1]:
        folder = shared_folder(spark)
        docs = store(work(spark, docs, sf_dir), folder)
        if last:
            remove_folder(spark, last)
        last = folder
    return STAGES[-1][1](spark, docs, sf_dir)

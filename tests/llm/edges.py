"""Tables of edge cases for the operators on documents."""

import random

KINDS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns with names that operators use for themselves.
CLASHING = ("row", "id", "digest", "at", "size", "bucket", "shard", "key", "name", "score", "text_sha256")


def words(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def table(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, KINDS)
    if clashing:
        df = df.selectExpr("*", *[f"'kept {c}' AS `{c}`" for c in CLASHING])
    return df


def edge_rows():
    long = words(1, 20_000, 5000)
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, "   \n", "en", "a", 4),
        (4, "one", "en", None, 3),
        (5, "one", "fr", "b", 3),
        (5, "one", "fr", "b", 3),
        (None, "no id here at all", "en", "a", 17),
        (None, None, None, None, None),
        (8, long, "en", "b", len(long)),
        (9, "12345 !!! ...", "en", "a", 13),
        (10, words(2, 30), "de", "c", 1),
        (11, words(2, 30) + " more", "de", "c", 1),
    ]
    return rows

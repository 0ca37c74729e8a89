import random
import zlib

import numpy as np
import pytest

from offer_engine.llm import toxicity
from tests.llm.edges import edge_rows, table, words


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(700):
        ws = words(i, 40, 600).split()
        toxic = rng.random() < 0.2
        if toxic:
            # Half by words of the lexicons, half by a stem that only labels can teach.
            bad = ["you", "idiot", "stupid"] if i % 2 else [f"grumv{rng.randrange(50)}x" for _ in range(3)]
            for b in bad:
                ws.insert(rng.randrange(len(ws)), b)
        rows.append((i, " ".join(ws), "en", "a", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def scored(spark, rows, labels, **options):
    truth = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return toxicity.score(table(spark, rows, **options), truth)


def test_held_out_accuracy(spark, corpus):
    rows, labels = corpus
    got = scored(spark, rows, labels).collect()
    truth = {i: t for i, _, t in labels}
    assert len(got) == len(rows)
    assert all(r.held_out == held(r.doc_id) for r in got)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    right = [r.predicted == truth[r.doc_id] for r in got if r.held_out]
    assert np.mean(right) > 0.97


def test_labels_of_the_held_out_fold_are_not_used(spark, corpus):
    rows, labels = corpus
    rows, labels = rows[:300], labels[:300]
    turned = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    score = lambda ls: {r.doc_id: r.score for r in scored(spark, rows, ls).collect()}
    assert score(labels) == score(turned)


def test_edges_and_clashing_columns(spark):
    rows = edge_rows()
    got = scored(spark, rows, [(4, 1, 1), (5, 1, 0), (5, 1, None), (None, 1, 1)], clashing=True).collect()
    assert len(got) == len(rows)
    assert {r["digest"] for r in got} == {"kept digest"}
    empty = {r.score for r in got if not (r.text or "").strip()}
    assert len(empty) == 1 and all(0 <= r.score <= 1 for r in got)


def test_without_labels_seed_lexicons_decide(spark, corpus):
    rows = corpus[0][:200] + [(9000, "you idiot . you are a stupid moron .", "en", "a", 0)]
    got = {r.doc_id: r.score for r in scored(spark, rows, []).collect()}
    assert got[9000] == max(got.values())


def test_empty(spark):
    assert scored(spark, [], []).count() == 0


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(1)
    y = rng.random(20_000) < 0.3
    fire = np.stack([rng.random(len(y)) < np.where(y, a, b) for a, b in ((0.8, 0.02), (0.6, 0.05), (0.7, 0.1))], 1)
    fire = np.column_stack([fire, fire[:, 2] ^ (rng.random(len(y)) < 0.02)])
    patterns = fire @ (1 << np.arange(4))
    model = toxicity.label_model(np.bincount(patterns, minlength=16).astype(float), np.zeros((2, 16)), 4)
    assert abs(model.balance - 0.3) < 0.05
    assert np.abs(model.accuracy[1] - [0.8, 0.6, 0.7, 0.7]).max() < 0.1
    assert (2, 3) in model.pairs


def test_labels_beyond_the_sample_give_equal_scores(spark, corpus, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 120)
    rows, labels = corpus[0][:250], corpus[1][:250]
    rows = rows + [(251, "g" * 100_000 + " you idiot", "en", "a", 0)]
    first = {r.doc_id: r.score for r in scored(spark, rows, labels).collect()}
    truth = spark.createDataFrame(labels[::-1], "doc_id long, quality int, toxic int").repartition(5)
    again = toxicity.score(table(spark, rows[::-1]).repartition(7), truth)
    assert {r.doc_id: pytest.approx(r.score, abs=1e-9) for r in again.collect()} == first


def test_voters_that_hardly_fire_are_no_pairs():
    counts = np.full(8, 1e-9)
    counts[[0, 1]] = 500, 100
    assert toxicity.dependent(counts, toxicity.fired_table(3)) == []
    assert toxicity.correlated([counts, counts], toxicity.fired_table(3)) == []

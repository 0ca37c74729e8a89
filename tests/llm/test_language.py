import random
import zlib

import numpy as np
import pytest

from offer_engine.llm import language
from tests.llm.edges import edge_rows, table

SOUNDS = {
    "aa": ["ka", "lo", "mi", "ru", "sa"],
    "bb": ["esch", "tung", "lich", "ver", "ein"],
    "cc": ["eaux", "que", "ment", "oi", "tré"],
}


def sentence(lang, n, rng):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    return [
        (i, sentence(lang, 30, rng), lang, "s", 0) for i, lang in enumerate(rng.choices(list(SOUNDS), k=400))
    ]


def brute_force(emit, begin, step):
    """Marginals of one short sequence by summing over all label sequences."""
    from itertools import product

    n, k = emit.shape
    out = np.zeros((n, k))
    for path in product(range(k), repeat=n):
        p = begin[path[0]] * emit[0, path[0]]
        for t in range(1, n):
            p *= step[path[t - 1], path[t]] * emit[t, path[t]]
        for t, y in enumerate(path):
            out[t, y] += p
    return out / out.sum(1, keepdims=True)


@pytest.mark.parametrize("chunk", [1, 2, 3, 5, 64])
def test_forward_backward_like_brute_force(chunk):
    rng = np.random.default_rng(5)
    lengths = [1, 6, 3, 1, 5]
    emit = rng.random((sum(lengths), 3)) + 0.01
    begin, step = rng.random(3) + 0.1, rng.random((3, 3)) + 0.1
    first = np.concatenate([np.arange(n) == 0 for n in lengths])
    got = language.forward_backward(emit, first, begin, step, chunk)
    at = 0
    for n in lengths:
        assert np.allclose(got[at : at + n], brute_force(emit[at : at + n], begin, step))
        at += n
    pairs = language.pair_marginals(emit, first, begin, step, got, np.flatnonzero(~first))
    assert np.isclose(pairs.sum(), sum(n - 1 for n in lengths))
    assert np.allclose(pairs.sum(0), got[~first].sum(0))


def test_held_out_accuracy(spark, corpus):
    got = language.identify(table(spark, corpus)).collect()
    lang = {r[0]: r[2] for r in corpus}
    assert len(got) == len(corpus)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in got if r.held_out]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_the_held_out_fold_are_not_used(spark, corpus):
    turned = [
        (i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, s, n) for i, t, lang, s, n in corpus
    ]
    pred = lambda rows: {r.doc_id: (r.lang_pred, r.score) for r in language.identify(table(spark, rows)).collect()}
    assert pred(corpus) == pred(turned)


def test_words_of_switching_texts_are_labelled(corpus):
    fitted = language.fit([(r[2], r[1].split()) for r in corpus[:200]])
    rng = random.Random(9)
    ws = sentence("aa", 15, rng).split() + sentence("bb", 15, rng).split()
    rows = fitted.look_up(ws)
    gamma = language.forward_backward(fitted.emit[rows], np.arange(30) == 0, fitted.begin, fitted.step)
    labels = [fitted.languages[i] for i in gamma.argmax(1)]
    assert np.mean([a == b for a, b in zip(labels, ["aa"] * 15 + ["bb"] * 15, strict=True)]) > 0.9


def test_edges_and_clashing_columns(spark, corpus):
    rows = edge_rows()
    got = language.identify(table(spark, rows + corpus, clashing=True)).collect()
    assert len(got) == len(rows) + len(corpus)
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (r.score == 0) == (not letters)
    assert {r["digest"] for r in got} == {"kept digest"}


def test_without_labels_and_empty(spark):
    rows = [(i, "some words", None, "s", 0) for i in range(5)]
    assert {r.lang_pred for r in language.identify(table(spark, rows)).collect()} == {"und"}
    assert language.identify(table(spark, [])).count() == 0


def test_every_one_of_forty_languages_is_learned(spark):
    """Also the rare ones."""
    rng = random.Random(8)
    rows = []
    for n in range(40):
        sounds = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(6)]
        for _ in range(12 if n < 8 else 40):
            text = " ".join("".join(rng.choices(sounds, k=2)) for _ in range(20))
            rows.append((len(rows), text, f"l{n:02}", "s", 0))
    lang = {r[0]: r[2] for r in rows}
    got = language.identify(table(spark, rows)).collect()
    assert {r.lang_pred for r in got} == set(lang.values())
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in got if r.held_out]) > 0.95


def test_numbers_that_are_word_characters_are_no_letters(spark):
    assert [language.letters(c) for c in ("½", "²a", "①", "Straße!", "x_1y", "é")] == ["", "a", "", "straße", "xy", "é"]
    rows = [(i, "one two three", "en", "a", 0) for i in range(20)] + [(100, "½ ² ①", "en", "a", 0)]
    got = {r.doc_id: r for r in language.identify(table(spark, rows)).collect()}
    assert (got[100].lang_pred, got[100].score) == ("und", 0.0)

"""Language of words and texts by a linear-chain conditional random field.

A word is seen through hashed features: its character n-grams, its affixes (n-grams with the
word's edge) and its entry in a lexicon learned from the training words. Transitions between the
languages of neighbouring words are learned, so a text may switch between them. Forward-backward
gives each word a distribution; a text's language is the one with the largest sum over its words.

The field is fitted on a bounded sample: WINDOWS stretches of WINDOW_WORDS words of labelled
texts, the stretch of a text chosen by hash, shared out evenly to languages. Every language is
learned: with many, each still has LEAST_STRETCHES and the sample grows. Half of the training
sequences join stretches of two texts, so that switches occur in them.

Edge cases: a null text, or one without letters, has the language `und` and score 0. Without any
labelled text with letters every text is `und`. A null key hashes as the empty one. Equal rows
get equal results. An empty table gives an empty one. Texts of any length are scored whole.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offer_engine.llm.common import packed, ship, unpacked

UNKNOWN = "und"
#: Bound of the training sample, and words of each of its stretches.
WINDOWS = 4000
WINDOW_WORDS = 64
#: Stretches of a language at least, where it has them.
LEAST_STRETCHES = 50
#: Hashed features.
FEATURES = 1 << 16
EPOCHS = 6
#: Words that are scored at once; chunks of a text that a task remembers.
BLOCK_WORDS = 1 << 17
CACHE = 150_000
#: New words whose features are held at once.
NEW_WORDS = 1 << 13

ADDED = ("held_out", "lang_pred", "score")

not_letters = re.compile(r"[\W\d_]+")


def letters(chunk: str) -> str:
    """The letters of a chunk between white space, in lower case."""
    found = chunk.lower() if chunk.isalpha() else not_letters.sub("", chunk.lower())
    # Fractions, raised and circled numbers are word characters, but no letters.
    return found if not found or found.isalpha() else "".join(filter(str.isalpha, found))


def features(words: Sequence[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words, one after the other, and how many each word has."""
    marked = "".join(f"\x02{w}\x03" for w in words)
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words])
    end = np.repeat(np.cumsum(lengths), lengths)
    start = end - np.repeat(lengths, lengths)
    at = np.arange(len(codes))
    word = np.repeat(np.arange(len(words)), lengths)
    found, owner = [], []
    prime = np.uint64(0x100000001B3)
    rolled = np.full(len(codes), 0xCBF29CE484222325, np.uint64)
    for n in range(1, 6):
        rolled = rolled[: len(codes) - n + 1] if n > 1 else rolled
        rolled = (rolled ^ codes[n - 1 :]) * prime
        here = at[: len(rolled)]
        ok = here + n <= end[: len(rolled)]
        if n == 1:
            continue
        if n > 3:  # affixes only
            ok &= (here == start[: len(rolled)]) | (here + n == end[: len(rolled)])
        h = rolled[ok]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
        found.append((h >> np.uint64(40)).astype(np.int64) % size)
        owner.append(word[: len(rolled)][ok])
    index, of = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(of, kind="stable")
    return index[order], np.bincount(of, minlength=len(words))


def forward_backward(
    emit: np.ndarray, first: np.ndarray, begin: np.ndarray, step: np.ndarray, chunk: int = 0
) -> np.ndarray:
    """Marginals of the words of many sequences laid one after the other.

    emit: words x labels, above 0. first: where a sequence begins. begin: weights of a first
    label; step: of a transition. The line of words is cut into chunks which are worked on side
    by side: first their transfer matrices, then what enters each from either end, then the words.
    """
    n, k = emit.shape
    chunk = chunk or max(8, int(n**0.5))
    count = -(-n // chunk)
    pad = count * chunk - n
    emit = np.concatenate([emit, np.ones((pad, k))]).reshape(count, chunk, k)
    first = np.concatenate([first, np.ones(pad, bool)]).reshape(count, chunk)
    transfer = np.broadcast_to(np.eye(k), (count, k, k)).copy()
    for t in range(chunk):
        moved = transfer @ step
        new = first[:, t]
        if new.any():
            moved[new] = transfer[new].sum(2, keepdims=True) * begin
        moved *= emit[:, t, None, :]
        transfer = moved / moved.sum((1, 2), keepdims=True)
    enter = np.empty((count, k))
    leave = np.empty((count, k))
    a = np.ones(k) / k
    for c in range(count):
        enter[c] = a
        a = a @ transfer[c]
        a /= a.sum()
    b = np.ones(k) / k
    for c in range(count - 1, -1, -1):
        leave[c] = b
        b = transfer[c] @ b
        b /= b.sum()
    alpha = np.empty((chunk, count, k))
    a = enter
    for t in range(chunk):
        moved = a @ step
        new = first[:, t]
        if new.any():
            moved[new] = begin
        a = moved * emit[:, t]
        a /= a.sum(1, keepdims=True)
        alpha[t] = a
    b = leave
    for t in range(chunk - 1, -1, -1):
        alpha[t] *= b
        weighed = b * emit[:, t]
        b = weighed @ step.T
        new = first[:, t]
        if new.any():
            b[new] = (weighed[new] * begin).sum(1, keepdims=True)
        b /= b.sum(1, keepdims=True)
    gamma = alpha.transpose(1, 0, 2).reshape(-1, k)[:n]
    return gamma / gamma.sum(1, keepdims=True)


@dataclass
class Field:
    """The fitted field, and what it remembers of words it has seen."""

    languages: list[str]
    weights: np.ndarray
    begin: np.ndarray
    step: np.ndarray
    lexicon: dict[str, int]
    rows: dict[str, int] = field(default_factory=dict)
    emit: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"rows": {}, "emit": None}

    def emissions(self, words: Sequence[str]) -> np.ndarray:
        """Words x languages; a word without letters weighs the same for all."""
        size = len(self.weights) - len(self.languages)
        out = np.zeros((len(words), len(self.languages)))
        full = [i for i, w in enumerate(words) if w]
        for at in range(0, len(full), NEW_WORDS):
            part = full[at : at + NEW_WORDS]
            index, counts = features([words[i] for i in part], size)
            starts = np.cumsum(counts) - counts
            scores = np.add.reduceat(self.weights[index], starts, axis=0)
            known = [self.lexicon.get(words[i], -1) for i in part]
            scores += np.where(
                np.array(known)[:, None] >= 0, self.weights[size + np.maximum(known, 0)], 0
            )
            out[part] = scores
        return np.exp(out - out.max(1, keepdims=True))

    def look_up(self, chunks: list[str]) -> np.ndarray:
        """Rows of self.emit for chunks of text; row 0 is that of chunks without letters."""
        if self.emit is None or len(self.rows) > CACHE:
            self.rows = {}
            self.emit = np.ones((1, len(self.languages)))
        rows = self.rows
        found = [rows.get(c, -1) for c in chunks]
        fresh = {c for c, r in zip(chunks, found, strict=True) if r < 0}
        if fresh:
            new = [(c, letters(c)) for c in sorted(fresh)]
            words = [w for _, w in new if w]
            at = len(self.emit)
            for c, w in new:
                rows[c] = at if w else 0
                at += bool(w)
            if words:
                self.emit = np.concatenate([self.emit, self.emissions(words)])
            found = [rows[c] if r < 0 else r for c, r in zip(chunks, found, strict=True)]
        return np.array(found, np.int64)

    def shares(self, texts: Sequence[list[str]]) -> np.ndarray:
        """Texts x languages: mean marginals of the words with letters; 0 where there is none."""
        lengths = np.array([len(t) for t in texts])
        out = np.zeros((len(texts), len(self.languages)))
        rows = self.look_up([c for t in texts for c in t])
        of = np.repeat(np.arange(len(texts)), lengths)
        rows, of = rows[rows > 0], of[rows > 0]
        if len(rows):
            first = np.concatenate([[True], of[1:] != of[:-1]])
            gamma = forward_backward(self.emit[rows], first, self.begin, self.step)
            with_words = of[first]
            out[with_words] = np.add.reduceat(gamma, np.flatnonzero(first), axis=0)
            out[with_words] /= np.bincount(of)[with_words][:, None]
        return out


def sequences(samples: list[tuple[str, list[str]]], index: dict[str, int], seed: int):
    """Training sequences of (words, label numbers); half of them join parts of two texts."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(samples))
    out = []
    for i, j in zip(order, rng.permutation(len(samples)), strict=True):
        lang, words = samples[i]
        labels = [index[lang]] * len(words)
        if rng.random() < 0.5 and len(words) > 1:
            cut = int(rng.integers(1, len(words)))
            other, more = samples[j]
            more = more[: len(words) - cut]
            words = words[:cut] + more
            labels = labels[:cut] + [index[other]] * len(more)
        out.append((words, labels))
    return out


def fit(samples: list[tuple[str, list[str]]], size: int = FEATURES, epochs: int = EPOCHS) -> Field:
    """Fit a field to (language, words) by maximum likelihood, with AdaGrad."""
    samples = [(lang, ws) for lang, ws in samples if ws]
    languages = sorted({lang for lang, _ in samples})
    index = {x: i for i, x in enumerate(languages)}
    k = len(languages)
    per_word: dict[str, Counter] = defaultdict(Counter)
    for lang, ws in samples:
        for w in ws:
            per_word[w][lang] += 1
    lexicon = {}
    for w, c in per_word.items():
        lang, n = c.most_common(1)[0]
        if n >= 5 and n >= 0.9 * c.total():
            lexicon[w] = index[lang]
    vocabulary = sorted(per_word)
    number = {w: i for i, w in enumerate(vocabulary)}
    if not vocabulary:
        return Field([], np.zeros((size, 0)), np.zeros(0), np.zeros((0, 0)), {})
    feats, counts = features(vocabulary, size)
    starts = np.cumsum(counts) - counts
    known = np.array([lexicon.get(w, -1) for w in vocabulary])
    weights = np.zeros((size + k, k))
    begin, step = np.zeros(k), np.zeros((k, k))
    sums = [np.full(x.shape, 1e-3) for x in (weights, begin, step)]
    rate, batch, decay = 0.3, 128, 1e-6
    for epoch in range(epochs):
        lines = sequences(samples, index, epoch)
        for b in range(0, len(lines), batch):
            part = lines[b : b + batch]
            words = np.array([number[w] for ws, _ in part for w in ws])
            gold = np.array([y for _, ys in part for y in ys])
            first = np.concatenate([np.arange(len(ws)) == 0 for ws, _ in part])
            types, inverse = np.unique(words, return_inverse=True)
            spans = [np.arange(s, s + n) for s, n in zip(starts[types], counts[types], strict=True)]
            index_of = feats[np.concatenate(spans)]
            at = np.cumsum(counts[types]) - counts[types]
            score = np.add.reduceat(weights[index_of], at, axis=0)
            in_lexicon = known[types] >= 0
            score[in_lexicon] += weights[size + known[types][in_lexicon]]
            emit = np.exp(score - score.max(1, keepdims=True))[inverse]
            first_w = np.exp(begin - begin.max())
            step_w = np.exp(step - step.max())
            gamma = forward_backward(emit, first, first_w, step_w)
            want = np.eye(k)[gold]
            change = want - gamma
            by_type = np.stack(
                [np.bincount(inverse, change[:, c], minlength=len(types)) for c in range(k)], 1
            )
            spread = np.repeat(by_type, counts[types], axis=0)
            grad = np.zeros_like(weights)
            for c in range(k):
                grad[:size, c] = np.bincount(index_of, spread[:, c], minlength=size)
                lex = known[types][in_lexicon]
                grad[size:, c] = np.bincount(lex, by_type[in_lexicon, c], minlength=k)
            # Expected transitions, from the marginals of pairs of neighbours.
            nxt = np.flatnonzero(~first)
            pair = pair_marginals(emit, first, first_w, step_w, gamma, nxt)
            step_grad = np.zeros((k, k))
            np.add.at(step_grad, (gold[nxt - 1], gold[nxt]), 1.0)
            step_grad -= pair
            begin_grad = change[first].sum(0)
            for x, g, s in zip((weights, begin, step), (grad, begin_grad, step_grad), sums, strict=True):
                g = g / len(part) - decay * x
                s += g * g
                x += rate * g / np.sqrt(s)
    return Field(languages, weights, np.exp(begin - begin.max()), np.exp(step - step.max()), lexicon)


def pair_marginals(emit, first, begin, step, gamma, nxt) -> np.ndarray:
    """Sum of the marginals of (label before, label) over the words `nxt` that have one before.

    P(before, label) is gamma(before) times P(label | before, the words from it on), and the
    latter is in proportion to step * emit * what comes after. That last factor is gamma / what
    comes before, so it is had from one more pass from the left.
    """
    k = emit.shape[1]
    out = np.zeros((k, k))
    left = np.empty_like(emit)
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(emit)))
    a = np.zeros((len(starts), k))
    for t in range(lengths.max()):
        on = lengths > t
        at = starts[on] + t
        moved = begin[None, :] * emit[at] if t == 0 else (a[on] @ step) * emit[at]
        moved /= moved.sum(1, keepdims=True)
        a[on] = moved
        left[at] = moved
    before = left[nxt - 1]
    reach = np.maximum(before @ step, 1e-300)
    # P(before, label) = alpha(before) step gamma(label) / sum over before of alpha step
    return step * (before.T @ (gamma[nxt] / reach)) if len(nxt) else out


def fold(key: Column, folds: int) -> Column:
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(folds))


def training_sample(docs: DataFrame, text: str, lang: str, key: str, windows: int):
    """At most `windows` (language, words), the documents chosen by the hash of their key.

    Languages share the bound evenly, with LEAST_STRETCHES for each even if that exceeds it. A document gives one stretch of WINDOW_WORDS words.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{lang}`").cast("string").alias("lang"),
        F.col(f"`{text}`").alias("text"),
        F.xxhash64(F.col(f"`{key}`").cast("string"), F.length(f"`{text}`")).alias("h"),
    ).filter("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return []
    share = max(windows // len(counts), LEAST_STRETCHES)
    unit = (F.col("h") / F.lit(2.0**64)) + 0.5
    limits = F.create_map(
        *[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, 1.2 * share / n))]
    )
    chosen = rows.filter(unit < F.try_element_at(limits, F.col("lang")))

    def stretches(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out = []
            for lang, text, h in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                chunks = text.split()
                at = h % max(1, len(chunks) - WINDOW_WORDS + 1)
                words = [w for w in map(letters, chunks[at : at + WINDOW_WORDS]) if w]
                out.append((lang, h, words))
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([o[0] for o in out], pa.string()),
                    "h": pa.array([o[1] for o in out], pa.int64()),
                    "words": pa.array([o[2] for o in out], pa.list_(pa.string())),
                }
            )

    found = chosen.mapInArrow(stretches, "lang string, h long, words array<string>")
    found = found.filter(F.size("words") > 0)
    first = Window.partitionBy("lang").orderBy("h", "words")
    found = found.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= share)
    found = sorted((r["lang"], r["h"], r["words"]) for r in found.collect())
    taken: Counter = Counter()
    out = []
    for lang, _, words in found:
        if words and taken[lang] < share:
            taken[lang] += 1
            out.append((lang, words))
    return out


def predict(
    docs: DataFrame,
    fitted: Field,
    text: str = "text",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The named columns of docs (all by default) with lang_pred and score, for every row."""
    ship(docs.sparkSession)
    names = docs.columns if columns is None else list(columns)
    rows = docs.select(packed(docs, names), F.col(f"`{text}`").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(fitted)

    def label(batches: Iterator[pa.RecordBatch]):
        model = sent.value
        for batch in batches:
            texts = batch.column(1)
            langs, scores = [], []
            block: list[list[str]] = []
            held = 0

            def settle():
                if not block:
                    return
                shares = model.shares(block) if model.languages else np.zeros((len(block), 1))
                best, top = shares.argmax(1), shares.max(1)
                for b, s in zip(best.tolist(), top.tolist(), strict=True):
                    langs.append(model.languages[b] if s > 0 else UNKNOWN)
                    scores.append(min(1.0, s))
                block.clear()

            for i in range(len(texts)):
                chunks = (texts[i].as_py() or "").split()
                if held and held + len(chunks) > BLOCK_WORDS:
                    settle()
                    held = 0
                block.append(chunks)
                held += len(chunks)
            settle()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["row", "lang_pred", "score"],
            )

    kind = rows.select("row").schema["row"].dataType.simpleString()
    result = rows.mapInArrow(label, f"row {kind}, lang_pred string, score double")
    return unpacked(result, names, ("lang_pred", "score"))


def identify(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    folds: int = 4,
    held: int = 2,
    windows: int = WINDOWS,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The named columns of docs (all by default), held_out, lang_pred and score for every row.

    Rows of the fold `held` are held out: the field is fitted on the others. A column of docs
    named as one of the results is replaced.
    """
    names = docs.columns if columns is None else list(columns)
    held_out = fold(F.col(f"`{key}`"), folds) == held
    fitted = fit(training_sample(docs.filter(~held_out), text, lang, key, windows))
    rows = docs.select(packed(docs, names), F.col(f"`{text}`").alias("text"), held_out.alias("held_out"))
    found = predict(rows, fitted, "text", ["row", "held_out"])
    return unpacked(found, names, ADDED)

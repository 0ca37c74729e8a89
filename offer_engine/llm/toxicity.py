"""Toxicity by weak supervision.

Voters look at a text, each for one thing: a word of one of the seed lexicons, words and stems of
lexicons learned from labelled texts, or a pattern such as an insult after "you". A generative label model
explains which voters fire together: a class balance, for each class how often each voter fires,
and how pairs of voters that are not independent within a class go together. It is fitted by
expectation maximisation on the counts of firing patterns over all texts outside the held-out
fold, with the labels that are known held fixed. Dependent pairs are found before that, from how
the voters' correlations depart from those that a class alone can make (rank one). A linear classifier on words and votes is then
trained on the posterior labels of a bounded sample of SAMPLE labelled texts, and scores every
text.

The sample holds one text of a document id (the largest) and one of a group of near copies (with the
larger label); ids are taken in the order of their hash, so every run learns from the same texts.

Edge cases: a null text is the empty text, which gets the classifier's score of no word. Labels
that are null do not count; of several labels of a document the largest does. Without labelled
texts the seed lexicons and patterns alone decide. A null key hashes as the empty one. Equal rows
get equal results. An empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offer_engine.llm.common import packed, ship, stored, unpacked
from offer_engine.llm.language import fold, letters

# Seed lexicons.
INSULTS = ("clown", "fool", "idiot", "imbecile", "jerk", "loser", "moron", "scum")
SCORN = ("disgusting", "dumb", "pathetic", "stupid", "trash", "worthless")
THREATS = ("hang", "hurt", "kill", "rot", "suffer")
ADDRESS = ("tu", "usted", "vous", "you", "your", "youre", "du", "ihr", "sie")

#: Bound of the labelled texts that lexicons and the classifier are learned from.
SAMPLE = 8000
#: Words and stems the classifier knows, and texts of the sample that must hold one.
WORDS = 5000
LEAST_TEXTS = 8
#: Lengths of stems, which are beginnings of words.
STEMS = range(3, 9)
#: From which share of toxic texts a word or stem is a strong or a weak sign, and the least count.
STRONG, WEAK, LEAST_TOXIC = 0.8, 0.5, 6
#: Minhashes of a text's words that near copies share, so that only one of them is learned from.
COPY_HASHES = 6
#: Correlation within a class from which a pair of voters is modelled.
CORRELATED = 0.05
#: Texts that a voter fires in, and that it does not fire in, for its correlations to be told.
LEAST_FIRED = 5
CACHE = 500_000

ADDED = ("held_out", "score", "predicted")

VOTERS = (
    "insult",
    "scorn",
    "threat",
    "two lexicon words",
    "lexicon word at the end of a sentence",
    "address before a lexicon word",
    "strong word",
    "strong stem",
    "two words with strong signs",
    "weak sign",
    "shouting",
)
shouted = re.compile(r"\b[A-ZÀ-Þ]{3,}\b[^a-z]{0,3}\b[A-ZÀ-Þ]{3,}\b.{0,80}!")


def stems(word: str) -> list[str]:
    """Beginnings of a word, marked so that they are not taken for words."""
    return [f"^{word[:n]}" for n in STEMS if n <= len(word)]


def parts(words: Sequence[str]) -> set[str]:
    """Words and stems of a text, and stems that two or more of its words share."""
    count = Counter(s for w in words for s in stems(w))
    return {*words, *count, *(f"2{s}" for s, n in count.items() if n > 1)}


@dataclass
class Signs:
    """What a word stands for: bits of lexicons, and the numbers of what the classifier knows."""

    strong: frozenset[str] = frozenset()
    weak: frozenset[str] = frozenset()
    number: dict[str, int] = field(default_factory=dict)
    seen: dict[str, tuple[int, str, tuple[int, ...]]] = field(default_factory=dict)

    def __post_init__(self):
        #: Of a stem's number: the number of the stem shared by two words, and its bits.
        self.twice = {
            self.number.get(x[1:], -1): (n, (x in self.strong) << 5 | (x in self.weak) << 6)
            for x, n in self.number.items()
            if x.startswith("2^")
        }

    def __getstate__(self):
        return self.__dict__ | {"seen": {}}

    def of(self, chunk: str) -> tuple[int, str, tuple[int, ...]]:
        word = letters(chunk)
        own = stems(word)
        bits = (
            (word in INSULTS)
            | (word in SCORN) << 1
            | (word in THREATS) << 2
            | (word in ADDRESS) << 3
            | (word in self.strong) << 4
            | (not self.strong.isdisjoint(own)) << 5
            | (word in self.weak or not self.weak.isdisjoint(own)) << 6
        )
        return bits, word, tuple(self.number[x] for x in (word, *own) if x in self.number)

    def read(self, text: str) -> tuple[int, list[int]]:
        """The pattern of the voters that fire, and the distinct known words and stems."""
        chunks = text.split()
        seen = self.seen
        if len(seen) > CACHE:
            seen.clear()
        distinct = set(chunks)
        for c in distinct.difference(seen):
            seen[c] = self.of(c)
        marked = {c for c in distinct if seen[c][0]}
        bits = 0
        for c in marked:
            bits |= seen[c][0]
        known = Counter(chain.from_iterable({f[1]: f[2] for f in map(seen.get, distinct) if f[2]}.values()))
        twice = [self.twice[n] for n, count in known.items() if count > 1 and n in self.twice]
        for _, more in twice:
            bits |= more
        lexicon, address, ends = [], set(), False
        if bits & 3:
            for i, c in enumerate(chunks):
                if c in marked:
                    if seen[c][0] & 3:
                        lexicon.append(i)
                        ends |= c[-1] in ".!?"
                    if seen[c][0] & 8:
                        address.add(i)
        strong = {seen[c][1] for c in marked if seen[c][0] & 48}
        fired = (
            bits & 1,
            bits & 2,
            bits & 4,
            len(lexicon) > 1,
            ends,
            any(not address.isdisjoint(range(i - 3, i)) for i in lexicon),
            bits & 16,
            bits & 32,
            len(strong) > 1,
            bits & 64,
            shouted.search(text),
        )
        numbers = sorted([*known, *(n for n, _ in twice)])
        return sum(bool(f) << i for i, f in enumerate(fired)), numbers


def fired_table(voters: int) -> np.ndarray:
    """All firing patterns as rows of 0 and 1."""
    return (np.arange(1 << voters)[:, None] >> np.arange(voters) & 1).astype(float)


@dataclass
class LabelModel:
    """P(toxic | pattern) for each pattern, and what it was worked out from."""

    posterior: np.ndarray
    balance: float
    accuracy: np.ndarray
    pairs: list[tuple[int, int]]


def log_linear(counts, terms, theta, rounds=200, ridge=1.0):
    """Weights of a log-linear distribution over all patterns whose moments match the counts'."""
    total = counts.sum()
    goal = (counts @ terms) / total
    for _ in range(rounds):
        p = np.exp(terms @ theta - np.max(terms @ theta))
        p /= p.sum()
        mean = p @ terms
        gap = goal - mean - ridge * theta / total
        if np.abs(gap).max() < 1e-6:
            break
        spread = (terms * p[:, None]).T @ terms - np.outer(mean, mean)
        spread[np.diag_indices_from(spread)] += ridge / total + 1e-9
        step = np.linalg.solve(spread, gap)
        theta = theta + np.clip(step, -1, 1)
    logits = terms @ theta
    top = logits.max()
    return theta, logits - top - np.log(np.exp(logits - top).sum())


def dependent(counts: np.ndarray, table: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of voters that go together for another reason than the class, found before any class
    is known.

    Voters that only the class links have correlations of rank one: a product of one number for
    each voter. While some pair departs from that by more than CORRELATED, the closest pair that
    departs from what all the other pairs say is taken out. Every voter keeps a triangle of
    pairs, without which its number is not known.
    """
    corr = correlations(counts, table)
    used = ~np.eye(len(corr), dtype=bool)
    found = []
    for i, j in sorted(combinations(range(len(corr)), 2), key=lambda x: -abs(corr[x])):
        link = rank_one(corr, used)
        if np.abs(corr - np.outer(link, link))[used].max(initial=0) <= CORRELATED:
            break
        used[i, j] = used[j, i] = False
        whole = used.astype(int)
        link = rank_one(corr, used)
        if np.diag(whole @ whole @ whole).min() > 0 and abs(corr[i, j] - link[i] * link[j]) > CORRELATED:
            found.append((i, j))
        else:
            used[i, j] = used[j, i] = True
    return sorted(found)


def correlations(counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Correlations of the voters; 0 for one that fires in, or not in, hardly a text."""
    p = counts / counts.sum()
    mean = p @ table
    cov = (table * p[:, None]).T @ table - np.outer(mean, mean)
    dev = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    told = counts.sum() * np.minimum(mean, 1 - mean) >= LEAST_FIRED
    return np.where(np.outer(told, told), cov / np.outer(dev, dev), 0.0)


def rank_one(corr: np.ndarray, used: np.ndarray, rounds: int = 100) -> np.ndarray:
    """The numbers whose products are nearest to the correlations that are used."""
    kept = np.where(used, corr, 0.0)
    link = np.full(len(corr), 0.5)
    for _ in range(rounds):
        for i in range(len(corr)):
            link[i] = kept[i] @ link / max(used[i] @ link**2, 1e-9)
        link = np.clip(link, -1, 1)
    return link


def label_model(free: np.ndarray, known: np.ndarray, voters: int, rounds: int = 40) -> LabelModel:
    """Fit the label model. free: counts of patterns of texts without a label; known: of those
    with one, by label (2 x patterns)."""
    table = fired_table(voters)
    counts = free + known.sum(0)
    pairs = dependent(counts, table) if counts.sum() else []
    # Before any fit a text is the likelier to be toxic the more voters fire, of which those that
    # go together count as one, unless labels of texts with its pattern say otherwise.
    share = 1 / (1 + np.bincount(np.array(pairs, int).ravel(), minlength=voters))
    signs = table @ share
    guess = np.clip(signs / 4, 0.02, 0.98)
    post = (known[1] + 4 * guess) / (known.sum(0) + 4)
    terms, theta = with_pairs(table, pairs), [np.zeros(voters + len(pairs)) for _ in range(2)]
    for turn in range(rounds):
        by_class = [known[0] + free * (1 - post) + 1e-9, known[1] + free * post + 1e-9]
        if turn == 10:
            # Pairs that are linked within a class as it now is, though not over all texts.
            more = [x for x in correlated(by_class, table) if x not in pairs]
            pairs = pairs + more
            terms = with_pairs(table, pairs)
            theta = [np.append(t, np.zeros(len(more))) for t in theta]
        fitted = [log_linear(c, terms, t) for c, t in zip(by_class, theta, strict=True)]
        theta = [f[0] for f in fitted]
        total = [c.sum() for c in by_class]
        odds = np.log(total[1] / total[0]) + fitted[1][1] - fitted[0][1]
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if turn > 12 and np.abs(new - post).max() < 1e-5:
            break
        post = new
    rates = np.stack([(c @ table) / c.sum() for c in by_class])
    return LabelModel(post, total[1] / sum(total), rates, sorted(pairs))


def with_pairs(table: np.ndarray, pairs: Sequence[tuple[int, int]]) -> np.ndarray:
    """The patterns' terms: each voter, and the product of each pair."""
    return np.column_stack([table, *[table[:, i] * table[:, j] for i, j in pairs]])


def correlated(by_class: Sequence[np.ndarray], table: np.ndarray) -> list[tuple[int, int]]:
    found = set()
    for counts in by_class:
        corr = correlations(counts, table)
        found |= {x for x in combinations(range(table.shape[1]), 2) if abs(corr[x]) > CORRELATED}
    return sorted(found)


@dataclass
class Classifier:
    bias: float
    votes: np.ndarray
    words: np.ndarray

    def scores(self, patterns: Sequence[int], words: Sequence[Sequence[int]]) -> np.ndarray:
        """Scores of texts by their patterns and known words, as one sparse product."""
        votes = np.asarray(patterns, int)[:, None] >> np.arange(len(self.votes)) & 1
        counts = np.array([len(w) for w in words], int)
        row = np.repeat(np.arange(len(words)), counts)
        col = np.fromiter(chain.from_iterable(words), int, counts.sum())
        z = self.bias + votes @ self.votes
        z += np.bincount(row, self.words[col], minlength=len(words))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(patterns: np.ndarray, words: list[list[int]], soft: np.ndarray, voters: int, size: int):
    """A linear classifier with soft labels: logistic loss, ridge, Adam on the whole sample."""
    votes = (patterns[:, None] >> np.arange(voters) & 1).astype(float)
    counts = np.array([len(w) for w in words], int)
    row = np.repeat(np.arange(len(words)), counts)
    col = np.array([i for w in words for i in w], int)
    n = len(words)
    balance = np.clip(soft.mean(), 1e-3, 1 - 1e-3)
    x = np.concatenate([[np.log(balance / (1 - balance))], np.zeros(voters + size)])
    ridge = np.concatenate([[0.0], np.full(voters, 0.3), np.full(size, 6.0)]) / n
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, 401):
        z = x[0] + votes @ x[1 : voters + 1]
        z += np.bincount(row, x[voters + 1 + col], minlength=n)
        gap = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - soft) / n
        g = np.concatenate([[gap.sum()], gap @ votes, np.bincount(col, gap[row], minlength=size)])
        g += ridge * x
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return Classifier(float(x[0]), x[1 : voters + 1], x[voters + 1 :])


def copy_sign(words: list[str]) -> int:
    """A hash of words, numbers included, that near copies share for the most part."""
    if not words:
        return 0
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    odd = np.random.default_rng(11).integers(1 << 62, 1 << 63, COPY_HASHES, dtype=np.uint64)
    least = (hashes[:, None] * (odd | np.uint64(1))).min(0)
    return xxhash.xxh64_intdigest(least.tobytes()) >> 1


def without_near_copies(sample: DataFrame) -> DataFrame:
    """toxic, text and the distinct words of the sample (text, toxic), one row of near copies."""

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            words = [sorted(set(map(letters, t.split())) - {""}) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(words, pa.list_(pa.string())),
                    pa.array([copy_sign(sorted(set(t.lower().split()))) for t in texts], pa.int64()),
                ],
                ["text", "toxic", "words", "sign"],
            )

    kind = "text string, toxic int, words array<string>, sign long"
    marked = sample.mapInArrow(work, kind)
    one = marked.groupBy("sign").agg(F.max(F.struct("toxic", "text", "words")).alias("one"))
    return stored(one.select("one.*"))


def learned(sample: DataFrame) -> Signs:
    """Lexicons and known words and stems from the sample (toxic, words)."""

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [sorted(parts(ws)) for ws in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.string()))], ["toxic", "parts"]
            )

    each = sample.mapInArrow(work, "toxic int, parts array<string>")
    totals = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    share = (totals["toxic"] or 0) / max(1, totals["n"])
    counts = each.select("toxic", F.explode("parts").alias("part")).groupBy("part").agg(
        F.count(F.lit(1)).alias("texts"), F.sum("toxic").alias("toxic")
    )
    telling = F.abs(F.col("toxic") - share * F.col("texts")) / F.sqrt("texts")
    counts = counts.filter(F.col("texts") >= LEAST_TEXTS).orderBy(telling.desc(), "part")
    rows = counts.limit(WORDS).collect()
    often = [r for r in rows if r["toxic"] >= LEAST_TOXIC]
    strong = frozenset(r["part"] for r in often if r["toxic"] >= STRONG * r["texts"])
    weak = frozenset(r["part"] for r in often if r["toxic"] >= WEAK * r["texts"])
    return Signs(strong, weak, {w: i for i, w in enumerate(sorted(r["part"] for r in rows))})


def read_all(rows: DataFrame, signs: Signs, kind: str) -> DataFrame:
    """Column 0 (of the given type), pattern and words of rows (column 0, text)."""
    sent = rows.sparkSession.sparkContext.broadcast(signs)

    def work(batches: Iterator[pa.RecordBatch]):
        model = sent.value
        for batch in batches:
            found = [model.read(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.int32()),
                    pa.array([f[1] for f in found], pa.list_(pa.int32())),
                ],
                ["c", "pattern", "words"],
            )

    return rows.mapInArrow(work, f"c {kind}, pattern int, words array<int>")


def fit(docs: DataFrame, labels: DataFrame, text: str, key: str, toxic: str, folds: int, held: int):
    """Signs, label model and classifier, from rows outside the held-out fold."""
    truth = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{toxic}`").cast("int").alias("toxic"))
    truth = truth.filter("toxic is not null").groupBy("key").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    ).filter(fold(F.col("key"), folds) != held)
    slim = docs.select(F.col(f"`{key}`").alias("key")).filter(fold(F.col("key"), folds) != held)
    with_label = slim.join(truth, "key").distinct()
    # The same texts in every run: of all keys the first by hash, of a key's texts the largest.
    picked = stored(with_label.orderBy(F.xxhash64("key"), "key").limit(SAMPLE))
    sample = rows.join(F.broadcast(picked), "key").groupBy("key", "toxic").agg(F.max("text").alias("text"))
    sample = sample.select("text", "toxic")
    sample = without_near_copies(sample)
    signs = learned(sample.select("toxic", "words"))
    voters = len(VOTERS)
    patterns = read_all(rows.select("key", "text"), signs, rows.schema["key"].dataType.simpleString())
    patterns = patterns.select(F.col("c").alias("key"), "pattern").join(truth, "key", "left")
    counts = patterns.groupBy("pattern", "toxic").count().collect()  # 3 * 2 ** voters rows at most
    free, known = np.zeros(1 << voters), np.zeros((2, 1 << voters))
    for r in counts:
        if r["toxic"] is None:
            free[r["pattern"]] += r["count"]
        else:
            known[int(r["toxic"] > 0), r["pattern"]] += r["count"]
    model = label_model(free, known, voters)
    read = read_all(sample.select("toxic", "text"), signs, "int").collect()
    if not read:
        # No labelled text: the label model's own log odds, as far as single voters go.
        weight = np.log((model.accuracy[1] + 1e-3) / (model.accuracy[0] + 1e-3))
        start = np.log((model.balance + 1e-3) / (1 - model.balance + 1e-3))
        return signs, model, Classifier(float(start) - 1, weight, np.zeros(0))
    at = np.array([r["pattern"] for r in read])
    words = [list(r["words"]) for r in read]
    return signs, model, train(at, words, model.posterior[at], voters, len(signs.number))


def score(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    toxic: str = "toxic",
    folds: int = 5,
    held: int = 0,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The named columns of docs (all by default), held_out, score and predicted for every row.

    Rows of the fold `held` are held out of all learning. A column of docs named as one of the
    results is replaced.
    """
    ship(docs.sparkSession)
    names = docs.columns if columns is None else list(columns)
    signs, _, classifier = fit(docs, labels, text, key, toxic, folds, held)
    rows = docs.select(
        packed(docs, names),
        F.col(f"`{text}`").alias("text"),
        (fold(F.col(f"`{key}`"), folds) == held).alias("held_out"),
    )
    sent = docs.sparkSession.sparkContext.broadcast((signs, classifier))

    def work(batches: Iterator[pa.RecordBatch]):
        model, linear = sent.value
        for batch in batches:
            found = [model.read(t.as_py() or "") for t in batch.column(1)]
            scores = linear.scores([f[0] for f in found], [f[1] for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(scores, pa.float64())],
                ["row", "held_out", "score"],
            )

    kind = rows.select("row").schema["row"].dataType.simpleString()
    found = rows.mapInArrow(work, f"row {kind}, held_out boolean, score double")
    found = found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    return unpacked(found, names, ADDED)

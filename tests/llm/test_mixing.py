import hashlib
import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from offer_engine.llm import mixing
from tests.llm.edges import edge_rows, table, words


def dealt(sizes, weights, share, most):
    """Targets by dealing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, left, open_ = {s: 0.0 for s in names}, share * sum(sizes.values()), set(names)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        over = 0.0
        for s in sorted(open_, key=str):
            goal[s] += left * weight[s] / total
            if goal[s] >= most * sizes[s]:
                over += goal[s] - most * sizes[s]
                goal[s] = most * sizes[s]
        open_ = {s for s in open_ if goal[s] < most * sizes[s]}
        left = over
    return goal


def expected(rows):
    def size(text):
        return len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w])

    def h(i):
        return int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)

    sizes = defaultdict(int)
    for i, t, _, s, _ in rows:
        sizes[s] += size(t)
    goal = dealt(sizes, (3, 1, 2), 1.5, 2)
    out = []
    for s in sizes:
        own = [(h(i), i, size(t)) for i, t, _, x, _ in rows if x == s]
        whole = int((goal[s] + 1e-9) // sizes[s]) if sizes[s] else 0
        need, by_hash = goal[s] - whole * sizes[s], defaultdict(int)
        for x, _, n in own:
            by_hash[x] += n
        below, before = set(), 0
        for x in sorted(by_hash):
            n = by_hash[x]
            if before + n <= need + 1e-9 or (before <= need and 2 * (need - before) > n):
                below.add(x)
            if before + n > need:
                break
            before += n
        out += [(i, n, sizes[s], round(goal[s], 6), n * (whole + (x in below))) for x, i, n in own]
    return sorted(out, key=str)


def found(df):
    return sorted(
        ((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=str
    )


def test_like_brute_force(spark):
    rng = random.Random(4)
    rows = [
        (i, words(i, rng.randrange(60)), "en", rng.choice(["a", "b", "c", "ü", None]), 0) for i in range(300)
    ]
    assert found(mixing.mix(table(spark, rows), columns=["doc_id"])) == expected(rows)


def test_source_with_a_third_of_rows_and_one_document(spark):
    rows = [(i, words(i, 20), "en", "hot", 0) for i in range(100)]
    rows += [(500, words(5, 9), "en", "alone", 0)]
    assert found(mixing.mix(table(spark, rows), columns=["doc_id"])) == expected(rows)


def test_edges_and_clashing_columns(spark):
    got = mixing.mix(table(spark, edge_rows(), clashing=True))
    assert got.count() == len(edge_rows())
    assert {r["row"] for r in got.select("row").collect()} == {"kept row"}
    assert found(got) == expected(edge_rows())


def test_empty(spark):
    assert mixing.mix(table(spark, [])).count() == 0


def test_mixed_repeats_documents(spark):
    rows = [(i, words(i, 20), "en", "ab"[i % 2], 0) for i in range(40)]
    taken = {r.doc_id: r.taken for r in mixing.mix(table(spark, rows)).collect()}
    copies = defaultdict(int)
    for r in mixing.mixed(table(spark, rows)).collect():
        copies[r.doc_id] += 20
    assert copies == {k: v for k, v in taken.items() if v}


def test_reruns_agree(spark):
    rows = [(i, words(i, i % 30), "en", "abc"[i % 3], 0) for i in range(90)]
    first = found(mixing.mix(table(spark, rows), columns=["doc_id"]))
    assert first == found(mixing.mix(table(spark, rows[::-1]).repartition(7), columns=["doc_id"]))


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 1000), min_size=1))
def test_dealing_ends_at_the_budget(sizes):
    goal = dealt(sizes, (3, 1, 2), 1.5, 2)
    assert abs(sum(goal.values()) - 1.5 * sum(sizes.values())) < 1e-6

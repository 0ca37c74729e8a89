import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from offer_engine.llm import repair
from offer_engine.llm.queries import QUERIES
from offer_engine.llm.repair_sql import SQL

KINDS = "conv_id long, turn long, role string, text string"
NEXT = {0: "user", 1: "user", 2: "assistant", 3: "user"}
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WHITE = " \t\n\x0b\x0c\r"


def key(value):
    return " " if value is None else str(value)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        hit = zlib.crc32(f"{key(conv)}:{key(turn)}".encode()) % 20
        role, text = key(role), key(text)
        if hit == 0:
            continue
        if hit == 1:
            text = ""
        if hit == 2:
            text = "".join(c for c in text if c not in ".!?")
        if hit == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if hit == 3 else 1)
    return out


def least(faults):
    """(cost, audit, lines) by trying every edit from every state, last turn first."""
    best = {0: (0, "", ()), 3: (0, "", ()), 2: (2, "I", ("assistant:",)), 1: (4, "II", ("user:", "assistant:"))}
    for role, text, fault in reversed(faults):
        after, best = best, {}
        cut = fault == "truncated"
        for q in range(4):
            options = [(3 + after[q][0], "D" + after[q][1], after[q][2])]
            if fault not in ("blank", "duplicate"):
                for letter, cost, name, to in (
                    ("K", 0, role, STEP.get((q, role[:1]))),
                    ("R", 2, NEXT[q], STEP[q, NEXT[q][0]]),
                ):
                    if to is not None:
                        c, a, lines = after[to]
                        options.append((c + cost + cut, letter + a, (f"{name}:{text}", *lines)))
            best[q] = min(options)
        for _ in range(3):
            for q in range(4):
                c, a, lines = best[STEP[q, NEXT[q][0]]]
                best[q] = min(best[q], (c + 2, "I" + a, (NEXT[q] + ":", *lines)))
    return best[0]


def brute(rows, original=None):
    found = {}
    for conv in {r[0] for r in (original or rows)}:
        mine = sorted(
            (r for r in rows if r[0] == conv),
            key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()),
        )
        seen, faults = set(), []
        for _, _, role, text in mine:
            bare = text.rstrip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append((role, text, fault))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = [sum(f == name for _, _, f in faults) for name in ("blank", "duplicate", "truncated")]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(faults[:-1], faults[1:], strict=True)]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        cost, audit, lines = least(faults)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        found[conv] = (conv, gaps, *count, illegal, cost, audit, digest)
    return found


def talks(seed, n, turns=12):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, turns)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = rng.choice([None, "", " \t", "Same.", "Yes", f"No {turn}?", f"Wörter {turn}!  \n", f"open {rng.random()}"])
            rows.append((conv, rng.choice([turn, turn, turn * 2, 3, None]), role, text))
    return rows + [(None, 1, "user", "Hello."), (None, None, "assistant", "Hi.")]


def report(spark, rows, **options):
    df = spark.createDataFrame(rows, KINDS).repartition(3)
    return {r.conv_id: tuple(r) for r in repair.repair_report(repair.damaged(df), df, **options).collect()}


@pytest.mark.parametrize("block, chunk", [(4, 1 << 16), (1, 3), (3, 5)])
def test_like_brute_force(spark, block, chunk):
    rows = talks(block, 150)
    assert report(spark, rows, block=block, chunk=chunk) == brute(damage(rows), rows)


def test_one_long_conversation_over_many_tasks(spark):
    rng = random.Random(5)
    rows = [(7, i, rng.choice(["user", "assistant", "system"]), rng.choice(["Same.", "cut", f"t {i}."])) for i in range(5000)]
    rows += talks(3, 20)
    rows = [r for r in rows if r[0] != 7 or r[1] is not None]
    assert report(spark, rows, chunk=64) == brute(damage(rows), rows)


def test_blocks_of_any_length_agree():
    rng = random.Random(2)
    for _ in range(300):
        symbols = repair.np.array([rng.randrange(repair.SYMBOLS) for _ in range(rng.randrange(30))], dtype="int64")
        found = set()
        for block in (1, 2, 4):
            table = repair.tables(block)
            to, cost = table.through(symbols)
            letters, end = table.walk(symbols, 0, 0)
            found.add((letters + table.closing(end)[0], int(cost[0]) + table.vectors[to[0]][0]))
        assert len(found) == 1
    assert len(repair.tables().vectors) < 50


def test_repaired_turns_are_sound(spark):
    rows = talks(9, 60)
    df = spark.createDataFrame(rows, KINDS)
    lines = repair.repaired_turns(repair.damaged(df)).collect()
    want = brute(damage(rows), rows)
    for conv in {r.conv_id for r in lines}:
        kept = sorted((r.place, f"{r.role}:{r.text}") for r in lines if r.conv_id == conv and r.place is not None)
        assert [p for p, _ in kept] == list(range(len(kept)))
        assert hashlib.sha256("\n".join(t for _, t in kept).encode()).hexdigest() == want[conv][-1]


def test_long_text_extra_columns_and_all_rows_dropped(spark):
    gone = next(i for i in range(1000, 2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(1, 0, "user", "long " * 200_000), (1, 1, "assistant", "x" * 300_000 + "."), (gone, 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, KINDS)
    for name in ("at", "digest", "symbol", "sort", "first", "rows", "n", "right"):
        df = df.withColumn(name, F.lit("clash"))
    got = {r.conv_id: tuple(r) for r in repair.repair_report(repair.damaged(df), df).collect()}
    assert got == brute(damage(rows), rows)
    assert got[gone] == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty(spark):
    df = spark.createDataFrame([], KINDS)
    assert repair.repair_report(repair.damaged(df), df).count() == 0
    assert repair.repaired_turns(df).count() == 0


def test_query_like_brute_force_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r) for r in QUERIES["op11_repair"](spark, sf).collect()}
    assert got == brute(damage(rows), rows)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    assert {r[0]: r for r in con.sql(SQL).fetchall()} == got
    edge = talks(4, 80)
    con = duckdb.connect()
    con.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", edge)
    assert {r[0]: r for r in con.sql(SQL).fetchall()} == brute(damage(edge), edge)

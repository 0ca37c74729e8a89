"""Repair of conversation structure by Four-Russians block tables.

A conversation is sound if its roles read `(system? (user assistant)+)?`. Each turn is kept,
given the role of user or assistant, or deleted, and empty turns may be inserted; of the cheapest
edits, those whose initials (Delete, Insert, Keep, Rerole) are least as text are taken.

The costs to finish from each state of that grammar form a vector. Less its least entry it is one
of a few dozen vectors, so what BLOCK turns do to a vector is looked up in a table made once for
every vector and every block of turns. Turns are cut by ranges of (conversation, order) into
chunks; each chunk finds, by lookup, where it takes every vector; a scan over chunks, last first,
fixes the vector at each chunk's end; then chunks are walked first to last, their blocks expanded
backward from the known vectors, so the least of the cheapest edits is exact at each step.

A conversation of any length is many tasks' work up to there. The last walk brings a conversation's
texts together in order, as one digest over all of them asks for; it streams them and holds one
batch of rows, one chunk and the letters of one conversation.

Edge cases: null roles and texts count as one space, null conversation ids are one conversation.
Turns are ordered by turn (nulls first); ties by role, then by the text's digest, and rows equal in
all three are interchangeable. A role's initial is its first letter; any other than s, u or a can't
be kept. Empty and very long texts are turns like others. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offer_engine.llm.common import ship, stored

# Costs, letters, and what counts as white space and as the end of a sentence.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
# End of fixed values.

#: Turns of a block of the table, and of a chunk.
BLOCK = 4
CHUNK = 1 << 16

# States: nothing yet, after system, after user, after assistant. Next role of each that an edit
# can make, the state after it, and for each kind of turn (s, u, a, other) the state after keeping.
STATES, KINDS, GONE = 4, 4, 8
SYMBOLS = GONE + 1
MADE = ("user", "user", "assistant", "user")
AFTER = (2, 2, 3, 2)
KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
FINAL = (0, 3)
FAR = 10**6


def _with_inserts(costs: list[int]) -> list[int]:
    for _ in range(2):
        costs = [min(c, INSERT + costs[AFTER[q]]) for q, c in enumerate(costs)]
    return costs


def _steps(after: tuple[int, ...], symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of one turn in a state: letter, cost to the end of all, state after it."""
    cut = CUT if symbol in range(KINDS, GONE) else 0
    found = [("D", DELETE + after[state], state)]
    if symbol != GONE:
        kept = KEPT[symbol % KINDS].get(state)
        if kept is not None:
            found.append(("K", KEEP + cut + after[kept], kept))
        found.append(("R", REROLE + cut + after[AFTER[state]], AFTER[state]))
    return found


def _before(after: tuple[int, ...], symbol: int) -> tuple[tuple[int, ...], int]:
    """The normalised vector before a turn, and what was taken off."""
    costs = [min(c for _, c, _ in _steps(after, symbol, q)) for q in range(STATES)]
    costs = _with_inserts(costs)
    least = min(costs)
    return tuple(c - least for c in costs), least


class Tables:
    """Vectors that turns can lead to, and where blocks of up to `block` turns take them."""

    def __init__(self, block: int = BLOCK):
        last = tuple(_with_inserts([0 if q in FINAL else FAR for q in range(STATES)]))
        self.vectors, self.block = [last], block
        number, moves, at = {last: 0}, [], 0
        while at < len(self.vectors):
            row = []
            for symbol in range(SYMBOLS):
                vector, off = _before(self.vectors[at], symbol)
                if vector not in number:
                    number[vector] = len(self.vectors)
                    self.vectors.append(vector)
                row.append((number[vector], off))
            moves.append(row)
            at += 1
        one = np.array(moves, np.int64)
        # Tables for 0, 1, ... block turns; a block's code has its first turn as the highest digit.
        size = len(self.vectors)
        self.to = [np.arange(size)[:, None]]
        self.off = [np.zeros((size, 1), np.int64)]
        for _ in range(block):
            to, off = self.to[-1], self.off[-1]
            self.to.append(one[to, :, 0].transpose(0, 2, 1).reshape(size, -1))
            step = one[to, :, 1] + off[:, :, None]
            self.off.append(step.transpose(0, 2, 1).reshape(size, -1))
        self.expanded = lru_cache(100_000)(self._expanded)

    def codes(self, symbols: np.ndarray) -> list[tuple[int, int]]:
        """The blocks of a chunk as (length, code); the last one may be shorter."""
        weights = SYMBOLS ** np.arange(self.block - 1, -1, -1)
        full = len(symbols) // self.block * self.block
        found = [(self.block, int(c)) for c in symbols[:full].reshape(-1, self.block) @ weights]
        if rest := symbols[full:].tolist():
            code = 0
            for s in rest:
                code = code * SYMBOLS + s
            found.append((len(rest), code))
        return found

    def through(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector at a chunk's end, the vector at its start and the cost between."""
        at, cost = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        for n, code in reversed(self.codes(symbols)):
            cost = cost + self.off[n][at, code]
            at = self.to[n][at, code]
        return at, cost

    def _expanded(self, n: int, code: int, right: int, state: int) -> tuple[str, int]:
        """The least cheapest edits of one block from a state, and the state after it."""
        symbols = [code // SYMBOLS**k % SYMBOLS for k in range(n - 1, -1, -1)]
        known = [right]
        for s in reversed(symbols):
            known.append(int(self.to[1][known[-1], s]))
        known.reverse()
        letters = []
        for i, s in enumerate(symbols):
            after = self.vectors[known[i + 1]]
            off = int(self.off[1][known[i + 1], s])
            here = [c + off for c in self.vectors[known[i]]]
            while True:
                steps = [x for x in _steps(after, s, state) if x[1] == here[state]]
                if INSERT + here[AFTER[state]] == here[state]:
                    steps.append(("I", 0, AFTER[state]))
                letter, _, state = min(steps)
                letters.append(letter)
                if letter != "I":
                    break
        return "".join(letters), state

    def walk(self, symbols: np.ndarray, right: int, state: int) -> tuple[str, int]:
        """The least cheapest edits of a chunk whose end has a known vector."""
        blocks = self.codes(symbols)
        ends = [right]
        for n, code in reversed(blocks):
            ends.append(int(self.to[n][ends[-1], code]))
        letters = []
        for (n, code), end in zip(blocks, ends[-2::-1], strict=True):
            part, state = self.expanded(n, code, end, state)
            letters.append(part)
        return "".join(letters), state

    def closing(self, state: int) -> tuple[str, int]:
        """Inserts after the last turn."""
        n = 0
        while self.vectors[0][state]:
            state, n = AFTER[state], n + 1
        return "I" * n, state


@cache
def tables(block: int = BLOCK) -> Tables:
    return Tables(block)


ORDER = ("turn", "role", "digest", "at")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after the damage that crc32(`conv_id:turn`) % 20 names."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    hit = (F.crc32(F.concat_ws(":", *spaced[:2]).cast("binary")) % 20).alias("hit")
    rows = conversations.select("conv_id", "turn", spaced[2].alias("role"), spaced[3].alias("text"), hit)
    text = (
        F.when(F.col("hit") == 1, "")
        .when(F.col("hit") == 2, F.regexp_replace("text", f"[{ENDS}]", ""))
        .otherwise(F.col("text"))
    )
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        rows.filter("hit <> 0")
        .select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
        .drop("copy")
    )


def _symbols(turns: DataFrame) -> DataFrame:
    """Keys, order and one number for each turn: kind, + 4 if cut off, + 8 if blank, + 16 if a copy."""
    words = F.rtrim("text", F.lit(SPACE))
    keys = turns.select("conv_id", "turn", "role", "digest", "at", (words == "").alias("blank"),
                        (~F.substring(words, -1, 1).isin(*ENDS)).alias("cut"))
    first = keys.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn", "at")).alias("best"))
    first = first.select(F.col("best.at").alias("at"), F.lit(True).alias("first"))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    copy = F.col("first").isNull() & ~F.col("blank")
    cut = F.col("cut") & F.col("first").isNotNull() & ~F.col("blank")
    number = kind + 4 * cut.cast("int") + 8 * F.col("blank").cast("int") + 16 * copy.cast("int")
    # `at` is unique, so the copies of one turn are no hot key here.
    return keys.join(first, "at", "left").select("conv_id", *ORDER, number.cast("byte").alias("symbol"))


STATS = (
    "n long, rows binary, ends array<long>, low long, high long, turns long, blank long, duplicate long, "
    "truncated long, illegal long"
)
LEGAL = {(0, 1), (1, 2), (2, 1)}


def _summary(turn: list, rows: np.ndarray) -> tuple:
    known = [t for t in turn if t is not None]
    kinds = rows & 3
    bad = sum((a, b) not in LEGAL for a, b in zip(kinds[:-1].tolist(), kinds[1:].tolist(), strict=True))
    turns = len(known) and 1 + sum(a != b for a, b in zip(known[:-1], known[1:], strict=True))
    return (
        len(rows), rows.tobytes(), [int(kinds[0]), int(kinds[-1])], known[0] if known else None,
        known[-1] if known else None, turns, int((rows >> 3 & 1).sum()), int((rows >> 4 & 1).sum()),
        int((rows >> 2 & 1).sum()), bad,
    )


def _dp(rows: np.ndarray) -> np.ndarray:
    return np.where(rows & 24, GONE, rows & 7).astype(np.int64)


def _chunks(schema: pa.Schema, block: int, chunk: int):
    """Sorted turns of a partition to chunks of one conversation each."""

    def run(batches: Iterator[pa.RecordBatch]):
        table, part, seq = tables(block), TaskContext.get().partitionId(), 0
        current, held, out = None, [], []

        def close():
            nonlocal seq
            turn = [h[0] for h in held]
            rows = np.array([h[4] for h in held], np.uint8)
            to, cost = table.through(_dp(rows))
            out.append((current[0], *held[0][:4], part, seq, *_summary(turn, rows), to.tolist(), cost.tolist()))
            seq += 1
            held.clear()

        for batch in batches:
            for conv, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and (current != (conv,) or len(held) == chunk):
                    close()
                current = (conv,)
                held.append(row)
            if len(out) > 1000:
                yield _batch(out, schema)
                out = []
        if held:
            close()
        yield _batch(out, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _ends(schema: pa.Schema, block: int):
    """Chunks of each conversation, last first, to chunks with the vector at their end."""

    def run(batches: Iterator[pa.RecordBatch]):
        current, vector = None, 0
        for batch in batches:
            right = []
            for conv, to in zip(batch.column("conv_id").to_pylist(), batch.column("to"), strict=True):
                if current != (conv,):
                    current, vector = (conv,), 0
                right.append(vector)
                vector = to[vector].as_py()
            columns = [pa.array(right, pa.int32()) if f.name == "right" else batch.column(f.name) for f in schema]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


class _Conversation:
    """What is known of one conversation while its chunks and turns stream by."""

    def __init__(self, conv):
        self.conv, self.letters, self.state, self.hash = conv, [], 0, hashlib.sha256()
        self.sums, self.low, self.high, self.turns, self.last, self.last_kind = [0] * 4, None, None, 0, None, None
        self.cost, self.lines, self.edits, self.walked = 0, 0, iter(()), 0

    def chunk(self, table: Tables, row: dict):
        rows = np.frombuffer(row["rows"], np.uint8)
        symbols = _dp(rows)
        letters, end = table.walk(symbols, row["right"], self.state)
        self.edits, self.walked, self.state = iter(letters), self.state, end
        self.letters.append(letters)
        kept = [e for e in letters if e != "I"]
        cut = sum(CUT for e, s in zip(kept, symbols, strict=True) if e != "D" and KINDS <= s < GONE)
        self._paid(letters, cut)
        first, last = row["ends"]
        seam = self.last_kind is not None and (self.last_kind, first) not in LEGAL
        for i, name in enumerate(("blank", "duplicate", "truncated", "illegal")):
            self.sums[i] += row[name] + (seam if name == "illegal" else 0)
        self.last_kind = last
        if row["low"] is not None:
            self.turns += row["turns"] - (self.high is not None and self.high == row["low"])
            self.low = row["low"] if self.low is None else self.low
            self.high = row["high"]

    def _paid(self, letters: str, cut: int):
        self.cost += REROLE * letters.count("R") + DELETE * letters.count("D") + INSERT * letters.count("I") + cut

    def line(self, letter: str, role: str, text: str):
        """One line of the repaired conversation."""
        self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1
        return (self.conv, self.lines - 1, letter, role, text)

    def inserted(self, letter: str):
        made = self.line(letter, MADE[self.walked], "")
        self.walked = AFTER[self.walked]
        return made

    def turn(self, role: str, text: str) -> list[tuple]:
        """The lines that the edits make of the next turn, with inserts before it."""
        made = []
        while (letter := next(self.edits)) == "I":
            made.append(self.inserted(letter))
        if letter == "K":
            self.walked = KEPT["sua".index(role[0])][self.walked]
            made.append(self.line(letter, role, text))
        elif letter == "R":
            role, self.walked = MADE[self.walked], AFTER[self.walked]
            made.append(self.line(letter, role, text))
        else:
            made.append((self.conv, None, letter, role, text))
        return made

    def close(self, table: Tables) -> list[tuple]:
        letters, _ = table.closing(self.state)
        self.letters.append(letters)
        self._paid(letters, 0)
        return [self.inserted(e) for e in letters]

    def report(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.sums, self.cost, "".join(self.letters), self.hash.hexdigest())


def _walk(schema: pa.Schema, block: int, lines: bool):
    """Chunks and turns in order to repaired lines, or to one report a conversation."""

    def run(batches: Iterator[pa.RecordBatch]):
        table, talk, out, held = tables(block), None, [], 0

        def close():
            made = talk.close(table)
            out.extend(made if lines else [talk.report()])

        for batch in batches:
            names = batch.schema.names
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                row = dict(zip(names, row, strict=True))
                if talk is None or talk.conv != row["conv_id"]:
                    if talk is not None:
                        close()
                    talk = _Conversation(row["conv_id"])
                if row["sort"] == 1:
                    talk.chunk(table, row)
                elif row["sort"] == 2:
                    made = talk.turn(row["role"], row["text"])
                    if lines:
                        out.extend(made)
                held += len(row["text"] or "") if lines else 1
                if held > 1 << 16:
                    yield _batch(out, schema)
                    out, held = [], 0
        if talk is not None:
            close()
        yield _batch(out, schema)

    return run


LINES = "place long, edit string, role string, text string"
REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def _schemas(df: DataFrame, columns: str) -> tuple[str, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    kind = df.schema["conv_id"].dataType.simpleString()
    schema: StructType = _parse_datatype_string(f"conv_id {kind}, {columns}")
    return f"conv_id {kind}, {columns}", to_arrow_schema(schema)


def _repaired(turns: DataFrame, known: DataFrame | None, lines: bool, block: int, chunk: int) -> DataFrame:
    ship(turns.sparkSession)
    text, role = (F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("text", "role"))
    rows = turns.select("conv_id", F.col("turn").cast("long"), role, text)
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    rows = stored(rows.select("*", digest, F.monotonically_increasing_id().alias("at")))
    order = ["conv_id", *ORDER]
    ranged = _symbols(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    keys = "turn long, role string, digest binary, at long"
    of_chunk, plan = _schemas(rows, f"{keys}, part int, seq int, {STATS}, to array<int>, cost array<long>")
    chunks = stored(ranged.mapInArrow(_chunks(plan, block, chunk), of_chunk))
    back = chunks.drop("cost").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq"))
    of_end, plan = _schemas(rows, f"{keys}, {STATS}, right int")
    ended = back.mapInArrow(_ends(plan, block), of_end).withColumns({"sort": F.lit(1), "text": F.lit(None).cast("string")})
    both = ended.unionByName(rows.withColumn("sort", F.lit(2)), allowMissingColumns=True)
    if known is not None:
        marks = known.select("conv_id").distinct().withColumn("sort", F.lit(0))
        both = both.unionByName(marks, allowMissingColumns=True)
    # A mark has neither turn nor role and comes first; a chunk comes before its first turn.
    ordered = both.repartition("conv_id").sortWithinPartitions(*order, "sort")
    needed = ["conv_id", "sort", "role", "text", "right", *[c.strip().split()[0] for c in STATS.split(", ")]]
    names, plan = _schemas(rows, LINES if lines else REPORT)
    return ordered.select(*needed).mapInArrow(_walk(plan, block, lines), names)


def repaired_turns(turns: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """One row per edit: conv_id, place in the repaired conversation (null if deleted), edit, role, text."""
    return _repaired(turns, None, True, block, chunk)


def repair_report(turns: DataFrame, known: DataFrame | None = None, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation: faults, cost, audit and the digest of the repaired lines.

    `known` may name conversations that have no turn left; they get zeros and an empty audit."""
    return _repaired(turns, known, False, block, chunk)

"""Removal of passages that repeat over documents, found by fixed-block anchors.

Any window of 2 * BLOCK words holds one whole block of its document's grid of BLOCK words. Each
document's blocks are the index, and every rolling stretch of BLOCK words is a probe. A block that
another document's block or probe equals is an anchor. Around each anchor a hit is extended by up
to BLOCK words on both sides: the windows that hold it meet their equals, and of each the least
document is found. Adjacent windows that started earlier elsewhere join to maximal exact repeats.

Texts lie in slots (see `slots`), which send blocks, probes and windows to hash buckets and get the
anchors and the windows' least documents back. The first number sent has 32 bits beside the
bucket's own, as a chance hit there only costs work; windows are told apart by 96 bits of two
independent hashes. Words are hashed from their bytes, a slot at a time. Equal texts are one text
with the least id, so copies are never compared.

Edge cases: null and empty texts have no words. A null id is never smaller than another: its
document neither loses words nor makes others lose any. Rows with equal ids are judged alike and
not against each other. Words are runs of characters other than white space, unchanged. A window
repeated in its own document alone stays. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offer_engine.llm.common import joined_groups, packed, ship, stored, unpacked
from offer_engine.llm.slots import (
    bucket_bits,
    digest_of,
    merged,
    pack,
    pack_sorted,
    rows_of,
    slot_count,
    text_slots,
    unpack,
    unpack_sorted,
    within,
)

#: Words of a block; a window has twice as many.
BLOCK = 25
#: Bytes of text of a slot. A task holds some twenty times as much: hashes of eight bytes a word,
#: and of every window of a text that repeats.
SLOT = 1 << 22
#: Bytes of text hashed at once; a longer word is hashed whole.
PIECE = 1 << 18
#: Odd bases of the two hashes, for bytes and for words, and what spreads their bits.
BYTE_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

ADDED = ("n_words", "n_removed", "kept_sha256", "spans")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


@cache
def _powers(base: int, bits: int) -> np.ndarray:
    powers = np.full(1 << bits, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** n modulo 2 ** 64."""
    return _powers(base, max(18, int(n).bit_length()))[: n + 1]


def rolled(values: np.ndarray, base: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of the stretches values[first:last]."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers(base, len(values))[:-1], dtype=np.uint64)])
    return mixed((sums[last] - sums[first]) * powers(pow(base, -1, 1 << 64), len(values))[first])


def word_hashes(data: bytes, hashes: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each word of a text starts, and its hashes."""
    starts, found, at = [], [[] for _ in range(hashes)], 0
    whole = np.frombuffer(data, np.uint8)
    while at < len(whole):
        size = PIECE
        while True:
            part = whole[at : at + size]
            white = (part == 32) | ((part >= 9) & (part <= 13))
            if at + size >= len(whole):
                break
            if white.any():
                end = int(np.flatnonzero(white)[-1]) + 1
                part, white = part[:end], white[:end]
                break
            size *= 2
        edges = np.flatnonzero(np.diff(np.concatenate([[True], white, [True]]).astype(np.int8)))
        first, last = edges[::2], edges[1::2]
        starts.append(first + at)
        wide = part.astype(np.uint64) + np.uint64(1)
        for h in range(hashes):
            found[h].append(rolled(wide, BYTE_BASES[h], first, last))
        at += len(part)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *starts]), [np.concatenate([none.astype(np.uint64), *f]) for f in found]


class Slot:
    """The texts of a slot, and hashes of stretches of their words."""

    def __init__(self, table: pa.Table, hashes: int):
        texts = merged(table)
        self.digests, self.ids, self.texts, self.n = ([t[i] for t in texts] for i in range(4))
        data = b"\n".join(self.texts)
        lengths = np.array([len(t) + 1 for t in self.texts], np.int64)
        begins = np.concatenate([[0], np.cumsum(lengths)])
        starts, self.hashes = word_hashes(data, hashes)
        self.first = np.searchsorted(starts, begins[:-1])
        self.last = np.append(self.first[1:], len(starts))
        self.words = len(starts)

    def stretches(self, words: int) -> np.ndarray:
        """Where a stretch of so many words of one text starts."""
        room = np.maximum(self.last - self.first - words + 1, 0)
        at = np.arange(int(room.sum())) - np.repeat(np.cumsum(room) - room, room)
        return at + np.repeat(self.first, room)

    def place(self, at: np.ndarray) -> np.ndarray:
        """The text of a word."""
        return np.searchsorted(self.first, at, "right") - 1

    def rolled(self, at: np.ndarray, words: int, which: int = 0) -> np.ndarray:
        return rolled(self.hashes[which], WORD_BASES[which], at, at + words)

    def owners(self) -> np.ndarray:
        """Least ids; texts of null ids alone come after all others."""
        return np.array([np.iinfo(np.int64).max if i is None else i for i in self.ids], np.int64)


def _split(keys: np.ndarray, bits: int) -> list[tuple[int, slice]]:
    """The runs of ascending keys that share their top bits."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.diff(bucket)) + 1
    ends = [0, *edges.tolist(), len(keys)]
    return [(int(bucket[a]), slice(a, b)) for a, b in zip(ends[:-1], ends[1:], strict=True) if b > a]


ASKED = pa.schema([("bucket", pa.int32()), ("slot", pa.int32()), ("blocks", pa.binary()), ("twice", pa.binary()), ("probes", pa.binary())])
ASKED_SQL = "bucket int, slot int, blocks binary, twice binary, probes binary"
ANCHORS = pa.schema([("slot", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary())])
ANCHORS_SQL = "slot int, bucket int, keys binary"
WINDOWS = pa.schema([("bucket", pa.int32()), ("slot", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("least", pa.binary()), ("many", pa.binary())])
WINDOWS_SQL = "bucket int, slot int, low binary, high binary, least binary, many binary"
LEAST = pa.schema([("slot", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("least", pa.binary())])
LEAST_SQL = "slot int, low binary, high binary, least binary"
FOUND = pa.schema([("digest", pa.binary()), ("id", pa.int64()), ("n", pa.int64()), ("n_words", pa.int64()),
                   ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                   ("kept_sha256", pa.string()), ("full_sha256", pa.string())])
FOUND_SQL = "digest binary, id long, n long, n_words long, spans array<struct<start:long,length:long>>, kept_sha256 string, full_sha256 string"


def asking(bits: int, block: int):
    """A slot's blocks and probes, by bucket."""

    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        slot = Slot(table, 1)
        at = slot.stretches(block)
        keys = slot.rolled(at, block) >> np.uint64(32 - bits)
        on_grid = (at - slot.first[slot.place(at)]) % block == 0
        grid, count = _by_text(keys[on_grid], slot.place(at[on_grid]))
        probes = np.unique(keys[~on_grid])
        out = {f.name: [] for f in ASKED}
        for b in np.unique(np.concatenate([grid, probes]) >> np.uint64(32)).tolist():
            ends = np.array([b << 32, (b + 1) << 32], np.uint64)
            one, two = (slice(*np.searchsorted(x, ends)) for x in (grid, probes))
            out["bucket"].append(b)
            out["slot"].append(key[0].as_py())
            out["blocks"].append(pack_sorted(grid[one].astype(np.uint32)))
            out["twice"].append(pack_sorted(grid[one][count[one] > 1].astype(np.uint32)))
            out["probes"].append(pack_sorted(probes[two].astype(np.uint32)))
        return rows_of(out, ASKED)

    return ask


def _by_text(keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how many texts have each."""
    order = np.lexsort((text, keys))
    keys, text = keys[order], text[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    return np.unique(keys[new], return_counts=True)


def anchors(table: pa.Table) -> pa.Table:
    """What each slot has of a bucket's anchors."""
    rows = [
        (s, b, unpack_sorted(x, np.uint32), unpack_sorted(y, np.uint32), unpack_sorted(z, np.uint32))
        for s, b, x, y, z in zip(*[table.column(c).to_pylist() for c in ("slot", "bucket", "blocks", "twice", "probes")], strict=True)
    ]
    none = np.zeros(0, np.uint32)
    blocks, count = np.unique(np.concatenate([none, *[r[2] for r in rows]]), return_counts=True)
    probed = [r[4][within(r[4], blocks)] for r in rows]
    met = np.unique(np.concatenate([blocks[count > 1], *[r[3] for r in rows], *probed]))
    out = {f.name: [] for f in ANCHORS}
    for (slot, bucket, own, _, _), hit in zip(rows, probed, strict=True):
        keys = np.union1d(own[within(own, met)], hit)
        if len(keys):
            out["slot"].append(slot)
            out["bucket"].append(bucket)
            out["keys"].append(pack_sorted(keys))
    return rows_of(out, ANCHORS)


def extending(bits: int, block: int):
    """The windows around a slot's anchors with the least id of each, by bucket."""

    def extend(key: tuple[pa.Scalar, ...], texts: pa.Table, answers: pa.Table) -> pa.Table:
        out = {f.name: [] for f in WINDOWS}
        if not texts.num_rows or not answers.num_rows:
            return rows_of(out, WINDOWS)
        slot = Slot(texts, 2)
        known = [
            (np.uint64(b) << np.uint64(32)) | unpack_sorted(k, np.uint32).astype(np.uint64)
            for b, k in zip(answers.column("bucket").to_pylist(), answers.column("keys").to_pylist(), strict=True)
        ]
        at = slot.stretches(block)
        hit = within(slot.rolled(at, block) >> np.uint64(32 - bits), np.sort(np.concatenate(known)))
        before = np.zeros(slot.words + 1, np.int64)
        before[at[hit] + 1] = 1
        before = np.cumsum(before)
        start = slot.stretches(2 * block)
        start = start[before[start + block + 1] > before[start]]
        low, high = slot.rolled(start, 2 * block), (slot.rolled(start, 2 * block, 1) >> np.uint64(32)).astype(np.uint32)
        owner = slot.owners()[slot.place(start)]
        order = np.lexsort((owner, high, low))
        low, high, owner = low[order], high[order], owner[order]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        begin = np.flatnonzero(new)
        most = np.maximum.reduceat(owner, begin) if len(begin) else owner
        many = most > owner[begin]
        low, high, owner = low[begin], high[begin], owner[begin]
        for b, part in _split(low, bits):
            out["bucket"].append(b)
            out["slot"].append(key[0].as_py())
            out["low"].append(pack_sorted(low[part]))
            out["high"].append(pack(high[part]))
            out["least"].append(pack(owner[part]))
            out["many"].append(np.packbits(many[part]).tobytes())
        return rows_of(out, WINDOWS)

    return extend


def least(table: pa.Table) -> pa.Table:
    """For each slot, its windows that started in a document with a smaller id, and the least one."""
    parts = []
    for row in zip(*[table.column(c).to_pylist() for c in ("slot", "low", "high", "least", "many")], strict=True):
        low = unpack_sorted(row[1], np.uint64)
        many = np.unpackbits(np.frombuffer(row[4], np.uint8))[: len(low)].astype(bool)
        parts.append((np.full(len(low), row[0], np.int32), low, unpack(row[2], np.uint32), unpack(row[3], np.int64), many))
    slot, low, high, owner, many = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((owner, high, low))
    slot, low, high, owner, many = slot[order], low[order], high[order], owner[order], many[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    first = owner[np.flatnonzero(new)][np.cumsum(new) - 1]
    told = (owner > first) | many
    order = np.flatnonzero(told)[np.argsort(slot[told], kind="stable")]
    out = {f.name: [] for f in LEAST}
    edges = np.flatnonzero(np.diff(slot[order])) + 1
    for part in np.split(order, edges) if len(order) else []:
        out["slot"].append(int(slot[part[0]]))
        out["low"].append(pack_sorted(low[part]))
        out["high"].append(pack(high[part]))
        out["least"].append(pack(first[part]))
    return rows_of(out, LEAST)


def removing(block: int):
    """The repeats of each text of a slot and digests of what is left."""

    def remove(texts: pa.Table, answers: pa.Table) -> pa.Table:
        out = {f.name: [] for f in FOUND}
        if not texts.num_rows:
            return rows_of(out, FOUND)
        asked = answers.num_rows > 0
        slot = Slot(texts, 2)
        covered = np.zeros(slot.words + 1, np.int64)
        if asked:
            low = np.concatenate([unpack_sorted(x, np.uint64) for x in answers.column("low").to_pylist()])
            high = np.concatenate([unpack(x, np.uint32) for x in answers.column("high").to_pylist()])
            first = np.concatenate([unpack(x, np.int64) for x in answers.column("least").to_pylist()])
            order = np.argsort(low, kind="stable")
            low, high, first = low[order], high[order], first[order]
            start = slot.stretches(2 * block)
            own = slot.rolled(start, 2 * block)
            at = np.minimum(np.searchsorted(low, own), len(low) - 1)
            hit = low[at] == own
            start, at = start[hit], at[hit]
            hit = (slot.rolled(start, 2 * block, 1) >> np.uint64(32)).astype(np.uint32) == high[at]
            start, at = start[hit], at[hit]
            start = start[first[at] < slot.owners()[slot.place(start)]]
            np.add.at(covered, start, 1)
            np.subtract.at(covered, start + 2 * block, 1)
        gone = np.cumsum(covered)[:-1] > 0
        for i, (digest, id_, text, n) in enumerate(zip(slot.digests, slot.ids, slot.texts, slot.n, strict=True)):
            words, part = text.split(), gone[slot.first[i] : slot.last[i]]
            full = kept = hashlib.sha256(b" ".join(words)).hexdigest()
            spans = []
            if id_ is not None and part.any():
                edges = np.flatnonzero(np.diff(np.concatenate([[False], part, [False]]).astype(np.int8)))
                spans = [{"start": a, "length": b - a} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
                kept = hashlib.sha256(b" ".join([w for w, g in zip(words, part.tolist(), strict=True) if not g])).hexdigest()
            for name, value in zip(FOUND.names, (digest, id_, n, len(words), spans, kept, full), strict=True):
                out[name].append(value)
        return rows_of(out, FOUND)

    return remove


def repeats(rows: DataFrame, block: int = BLOCK, slot_bytes: int = SLOT) -> DataFrame:
    """One row per text from rows of digest, id and text: its least id, number of rows, words,
    repeats and digests of what is left and of the whole."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = slot_count(size, slot_bytes)
    bits = bucket_bits(slots)
    texts = text_slots(rows, slots)
    asked = texts.groupBy("slot").applyInArrow(asking(bits, block), ASKED_SQL)
    found = asked.groupBy("bucket").applyInArrow(anchors, ANCHORS_SQL)
    windows = texts.groupBy("slot").cogroup(found.groupBy("slot")).applyInArrow(extending(bits, block), WINDOWS_SQL)
    known = windows.groupBy("bucket").applyInArrow(least, LEAST_SQL)
    return texts.groupBy("slot").cogroup(known.groupBy("slot")).applyInArrow(removing(block), FOUND_SQL)


def without_repeats(
    docs: DataFrame, block: int = BLOCK, text: str = "text", key: str = "doc_id", columns=None, slot_bytes: int = SLOT
) -> DataFrame:
    """The named columns of docs (all by default) for every row with n_words, n_removed,
    kept_sha256 and spans, the runs of words to remove as (start, length)."""
    ship(docs.sparkSession)
    names = docs.columns if columns is None else list(columns)
    id_ = F.col(f"`{key}`").cast("long").alias("id")
    whole = F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    texts = stored(repeats(docs.select(digest_of(text).alias("digest"), id_, whole), block, slot_bytes))
    rows = stored(docs.select(packed(docs, names), digest_of(text).alias("digest"), id_))
    groups = texts.withColumnRenamed("id", "least")
    found = joined_groups(rows, groups, "digest", "n", rows.count())
    # A copy of a text with a smaller id has all its windows there.
    copy = F.col("id") > F.col("least")
    gone = copy & (F.col("n_words") >= 2 * block)
    spans = (
        F.when(F.col("id").isNull() | (copy & ~gone), F.array().cast(groups.schema["spans"].dataType))
        .when(gone, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("length"))))
        .otherwise(F.col("spans"))
    )
    digest: Column = (
        F.when(F.col("id").isNull() | (copy & ~gone), F.col("full_sha256"))
        .when(gone, F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(F.col("kept_sha256"))
    )
    result = found.select("row", "n_words", spans.alias("spans"), digest.alias("kept_sha256")).withColumn(
        "n_removed", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    )
    return unpacked(result, names, ADDED)


def kept_text(text: Column, spans: Column) -> Column:
    """The words of a text that lie in no span, joined by one space."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.array_join(
        F.filter(words, lambda _, i: ~F.exists(spans, lambda s: (i >= s["start"]) & (i < s["start"] + s["length"]))), " "
    )

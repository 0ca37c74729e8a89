"""Alignment of two tokenizers over the same text.

A byte-level BPE encodes space + text, a sentencepiece model encodes the text and adds the space
itself. The first one's character offsets and the second one's spans are coarse cuts; a token that
ends inside a character, or stands for one byte of it, is cut by the length of its decoded bytes.
Where tokens of both end, a group ends; tokens whose bytes overlap are linked. How many documents
hold a linked pair of ids is counted over the whole corpus and told back to every document.

Neither tokenizer joins what lies before a space to what follows it, so a text is encoded in chunks
that begin with a space after another character. Signs that end a word of Latin letters are chunks
of their own if no piece of the second vocabulary has a letter before them. Chunks are remembered by a worker, up to
REMEMBERED bytes, those met again for longer; groups and links never leave a chunk. New chunks are
encoded a line at a time. Texts lie in slots (see `slots`) and are encoded once: a slot stores its
texts' groups and which of its pairs each text holds how often, and sends the pairs and in how many
documents they are to buckets by first id. The bucket's sums are streamed, so it holds the pairs of
its ids alone, and each slot gets the counts of its own pairs.
Equal texts are aligned once and counted as often as they occur.

Edge cases: null and empty texts, and texts that either tokenizer does not give back byte for byte,
have no tokens: zeros and an empty string. Rows with equal or null ids are documents each. Ties for
a highest count are all highest. Words of any length are chunks like others. An empty table gives
an empty one.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
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
)

#: Bytes of chunks and what is known of them that a worker remembers, and a chunk's own share.
REMEMBERED = 7 << 25
ENTRY = 400
COUNT = 40
#: Characters of a line of chunks that are encoded together, and bytes of texts aligned together.
LINE = 1 << 16
PORTION = 1 << 18
#: Bytes of text of a slot, and tasks at most for all slots.
SLOT = 1 << 22
TASKS = 100_000

ADDED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
SIGNS = ".,;:!?"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_plain = r" \s*\S*(?:[^\S ]\s*\S*)*"
_chunks = re.compile(_plain).findall
_parted = re.compile(rf" [{LETTERS}]+(?= |[{SIGNS}]+(?: |\Z))|[{SIGNS}]+(?= |\Z)|{_plain}").findall


def chunks(line: str, parted: bool = False) -> list[str]:
    """A line that begins with a space, cut before each space that follows another character than
    white space and is not part of the line's end. With `parted` also between a word of Latin
    letters and the signs that end it."""
    found = (_parted if parted else _chunks)(line)
    if len(found) > 1 and found[-1].isspace():
        found[-2:] = [found[-2] + found[-1]]
    return found


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def refined(coarse: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: coarse ends, but for those inside a character or at a byte that stands
    alone, which are where the token's decoded bytes end."""
    ends, decoded = coarse.copy(), np.cumsum(lengths)
    inside = ends != decoded
    ends[inside] = decoded[inside]
    return ends


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of tokens of two ascending lists of byte ends that overlap, and where each pair ends:
    between two cuts that follow each other lies one token of either."""
    ends = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
    ends = ends[np.diff(ends, prepend=-1) > 0]
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends), ends


class Aligner:
    """Both tokenizers and the chunks they have met.

    With `groups` the coarse cuts are taken and groups written; without it only links are found,
    from the lengths of the decoded bytes alone."""

    def __init__(self, first: str, second: bytes, groups: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(first)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        names = {i: t for t, i in self.a.get_vocab().items()}
        self.a_bytes = [bytes(letters.get(c, 63) for c in names.get(i, "")) for i in range(max(names) + 1)]
        self.b = SentencePieceProcessor(model_proto=second)
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.a_length, self.b_length = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        # A token's number with what follows it: another of its side, the other side, a next group.
        self.marked = [f"{i}{mark}" for mark, x in ((",", self.a_bytes), ("|", self.a_bytes), (",", self.b_bytes), (";", self.b_bytes)) for i in range(len(x))]
        # The first one never joins letters and signs if it cuts by its own pattern; nor does the
        # second if no piece has them so.
        plan = json.loads(first)
        kind = plan.get("pre_tokenizer") or {}
        joined = re.compile(f"[{LETTERS}][{SIGNS}]").search
        self.parted = (
            kind.get("type") == "ByteLevel"
            and kind.get("use_regex", True)
            and not plan.get("normalizer")
            and not any(joined(self.b.id_to_piece(i)) for i in range(len(self.b_bytes)))
        )
        self.groups = groups
        # Of each chunk the linked pairs of ids, its groups (each followed by `;`), and its numbers of
        # tokens and groups, COUNT bits each: plain values, which the collector need not visit.
        self.links: dict[str, bytes] = {}
        self.written: dict[str, str] = {}
        self.counts: dict[str, int] = {}
        self.broken: set[str] = set()
        self.again: set[str] = set()
        self.size = 0

    def spans(self, text: str, starts: np.ndarray | None) -> tuple[list[int], np.ndarray]:
        """Ids of the second tokenizer and the coarse byte ends of its pieces, its own space included."""
        if hasattr(self.b, "encode_as_immutable_proto"):
            pieces = self.b.encode_as_immutable_proto(text).pieces
            ends = np.array([p.end for p in pieces], np.int64) + 1
            return [p.id for p in pieces], ends if starts is None else starts[ends]
        pieces = self.b.encode(text, return_type="proto").pieces
        return [p.id for p in pieces], np.array([p.end for p in pieces], np.int64) + 1

    def encoded(self, line: str, data: bytes):
        """Ids and byte ends of both, or None if one of them does not give the line back."""
        coarse = self.a.encode(line, add_special_tokens=False)
        a, starts = coarse.ids, None
        if self.groups:
            if len(data) != len(line):
                # Where each character starts, and the end.
                starts = np.append(np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80), len(data))
            b, b_ends = self.spans(line[1:], starts)
        else:
            b = self.b.encode(line[1:])
        if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        if not self.groups:
            return a, b, np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        ends = np.array([e for _, e in coarse.offsets], np.int64)
        ends = ends if starts is None else starts[ends]
        return a, b, refined(ends, self.a_length[a]), refined(b_ends, self.b_length[b])

    def learn(self, lines: list[str]) -> None:
        """Align chunks that can stand in one line, one after another."""
        line = "".join(lines)
        data = line.encode()
        found = self.encoded(line, data)
        if found is None:
            if len(lines) == 1:
                self.broken.add(line)
                self.size += ENTRY + len(line)
            else:
                for chunk in lines:
                    self.learn([chunk])
            return
        a, b, a_ends, b_ends = found
        stops = np.cumsum([len(c.encode()) for c in lines])
        i, j, ends = overlaps(a_ends, b_ends)
        links = (a[i] << 32 | b[j]).astype(np.uint64).tobytes()
        of_links = np.searchsorted(ends, stops, "right").tolist()
        n_a, n_b = (np.searchsorted(x, stops, "right").tolist() for x in (a_ends, b_ends))
        if self.groups:
            cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
            n_groups = np.searchsorted(cuts, stops, "right").tolist()
            side = np.concatenate([np.searchsorted(cuts, a_ends) * 2, np.searchsorted(cuts, b_ends) * 2 + 1])
            last = np.concatenate([np.append(np.diff(side[: len(a)]), 1) > 0, np.append(np.diff(side[len(a) :]), 1) > 0])
            mark = np.concatenate([a, b + 2 * len(self.a_bytes)])
            mark[: len(a)] += last[: len(a)] * len(self.a_bytes)
            mark[len(a) :] += last[len(a) :] * len(self.b_bytes)
            written = list(map(self.marked.__getitem__, mark[np.argsort(side, kind="stable")].tolist()))
        at = (0, 0, 0, 0)
        for k, chunk in enumerate(lines):
            to = (n_a[k], n_b[k], n_groups[k] if self.groups else 0, of_links[k])
            self.links[chunk] = links[at[3] * 8 : to[3] * 8]
            if self.groups:
                self.written[chunk] = "".join(written[at[0] + at[1] : to[0] + to[1]])
                self.counts[chunk] = (to[0] - at[0] << COUNT | to[1] - at[1]) << COUNT | to[2] - at[2]
            at = to
        self.size += ENTRY * len(lines) + len(data) + len(links) + 8 * (len(a) + len(b))

    def forget(self) -> None:
        """Keep the chunks met again since the last time, unless these alone are too many."""
        kept = self.again if len(self.again) * 4 < len(self.links) * 3 else set()
        held = len(self.links)
        self.links, self.written, self.counts = (
            {c: known[c] for c in kept if c in known} for known in (self.links, self.written, self.counts)
        )
        self.size = self.size * len(self.links) // max(held, 1)
        self.broken, self.again = set(), set()

    def __call__(self, texts: list[bytes]) -> list[list[str] | None]:
        """The chunks of each text, all of them known now; None if a text has no tokens."""
        if self.size > REMEMBERED:
            self.forget()
        found = [chunks(" " + t.decode(), self.parted) if t else [] for t in texts]
        waiting, size = [], 0
        met = set().union(*found)
        new = met.difference(self.links, self.broken)
        self.again |= met - new
        for chunk in new:
            # What ends in white space, or has the sign that stands for it, would meet the next chunk.
            if chunk[0] != " ":
                self.learn([" a", chunk])
                continue
            if chunk[-1].isspace() or "▁" in chunk:
                self.learn([chunk])
                continue
            waiting.append(chunk)
            size += len(chunk)
            if size > LINE:
                self.learn(waiting)
                waiting, size = [], 0
        if waiting:
            self.learn(waiting)
        return [f if f and self.broken.isdisjoint(f) else None for f in found]


def portions(texts: list, size: int) -> Iterator[list]:
    """Runs of (digest, id, text, n) with about so many bytes of text."""
    held, n = [], 0
    for row in texts:
        held.append(row)
        n += len(row[2])
        if n > size:
            yield held
            held, n = [], 0
    if held:
        yield held


@cache
def aligner(first: str, second: bytes, groups: bool) -> Aligner:
    """A worker keeps it for later tasks."""
    return Aligner(first, second, groups)


#: What a slot stores: its pairs by bucket, and its texts.
HELD = pa.schema([("slot", pa.int32()), ("bucket", pa.int32()), ("pairs", pa.binary()), ("docs", pa.binary())])
TEXTS = pa.schema([
    ("slot", pa.int32()), ("digest", pa.binary()), ("n", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("groups_sha256", pa.string()), ("groups", pa.string()), ("own", pa.binary()), ("times", pa.binary()),
])
STORED = pa.unify_schemas([HELD, TEXTS])
STORED_SQL = (
    "slot int, bucket int, pairs binary, docs binary, digest binary, n long, n_a long, n_b long, n_groups long, "
    "groups_sha256 string, groups string, own binary, times binary"
)
TOTAL = pa.schema([("bucket", pa.int32()), ("all_pairs", pa.binary()), ("totals", pa.binary()), ("best", pa.binary())])
TOTAL_SQL = "bucket int, all_pairs binary, totals binary, best binary"
TOLD = pa.schema([("slot", pa.int32()), ("pairs", pa.binary()), ("totals", pa.binary()), ("best", pa.binary())])
TOLD_SQL = "slot int, pairs binary, totals binary, best binary"
FOUND = pa.schema([("digest", pa.binary()), ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64())])
FOUND_SQL = "digest binary, n_links long, n_best long, count_sum long"


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of the values of each."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1)))
    return keys[first], np.add.reduceat(values, first) if len(first) else values


def holding(first, second, bits: int, with_groups: bool):
    """A slot's linked pairs and in how many documents each is, by bucket of the first id, and its
    texts with which of the slot's pairs, in ascending order, they hold how often."""

    def hold(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        align, slot = aligner(first.value, second.value, True), key[0].as_py()
        texts = {f.name: [] for f in TEXTS}
        pairs, times, mask = [], [], (1 << COUNT) - 1
        for part in portions(merged(table), PORTION):
            for found, (digest, _, _, n) in zip(align([t for _, _, t, _ in part]), part, strict=True):
                found = found or []
                own = np.frombuffer(b"".join(map(align.links.__getitem__, found)), np.uint64)
                own, often = np.unique(own, return_counts=True)
                pairs.append(own)
                times.append(often)
                total = sum(map(align.counts.__getitem__, found))
                groups = "".join(map(align.written.__getitem__, found))[:-1]
                sha = hashlib.sha256(groups.encode()).hexdigest() if found else ""
                row = slot, digest, n, total >> 2 * COUNT, total >> COUNT & mask, total & mask, sha, groups if with_groups else None
                for name, value in zip(TEXTS.names, row):
                    texts[name].append(value)
        keys, number = np.unique(np.concatenate([np.zeros(0, np.uint64), *pairs]), return_inverse=True)
        sizes = [len(p) for p in pairs]
        docs = np.zeros(len(keys), np.int64)
        np.add.at(docs, number, np.repeat(np.array(texts["n"], np.int64), sizes))
        for own, often in zip(np.split(number.astype(np.uint32), np.cumsum(sizes)[:-1]), times):
            texts["own"].append(pack_sorted(own))
            texts["times"].append(pack(often.astype(np.uint32)))
        bucket = (keys >> np.uint64(32)) & np.uint64((1 << bits) - 1)
        order = np.argsort(bucket, kind="stable")
        out = {f.name: [] for f in HELD}
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
            out["slot"].append(slot)
            out["bucket"].append(int(bucket[part[0]]))
            out["pairs"].append(pack_sorted(keys[part]))
            out["docs"].append(pack(docs[part]))
        both = pa.concat_tables([rows_of(out, HELD), rows_of(texts, TEXTS)], promote_options="default")
        return both.select(STORED.names).cast(STORED)

    return hold


def totals(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of a bucket, their documents, and whether no other pair of the first id has more."""
    keys, docs = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        pairs = [unpack_sorted(x, np.uint64) for x in batch.column("pairs").to_pylist()]
        counts = [unpack(x, np.int64) for x in batch.column("docs").to_pylist()]
        keys, docs = summed(np.concatenate([keys, *pairs]), np.concatenate([docs, *counts]))
    ids = keys >> np.uint64(32)
    first = np.flatnonzero(np.diff(ids, prepend=ids[:1] + np.uint64(1)))
    most = np.repeat(np.maximum.reduceat(docs, first), np.diff(np.append(first, len(keys))))
    columns = [key[0].as_py()], [pack_sorted(keys)], [pack(docs)], [np.packbits(docs == most).tobytes()]
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, TOTAL, strict=True)], schema=TOTAL)


def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a slot asked of a bucket beside all that is known there, to what the slot needs."""
    bucket = known = None
    for batch in batches:
        out = {f.name: [] for f in TOLD}
        for row in batch.select(["bucket", "slot", "pairs", "all_pairs", "totals", "best"]).to_pylist():
            if bucket != row["bucket"]:
                bucket, docs = row["bucket"], unpack(row["totals"], np.int64)
                best = np.unpackbits(np.frombuffer(row["best"], np.uint8))[: len(docs)]
                known = unpack_sorted(row["all_pairs"], np.uint64), docs, best
            at = np.searchsorted(known[0], unpack_sorted(row["pairs"], np.uint64))
            out["slot"].append(row["slot"])
            out["pairs"].append(row["pairs"])
            out["totals"].append(pack(known[1][at]))
            out["best"].append(np.packbits(known[2][at]).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in TOLD], schema=TOLD)


def counted(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """The links of each text of a slot and the figures that all documents decide."""
    parts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row in answers.select(["pairs", "totals", "best"]).to_pylist():
        docs = unpack(row["totals"], np.int64)
        best = np.unpackbits(np.frombuffer(row["best"], np.uint8))[: len(docs)]
        for part, found in zip(parts, (unpack_sorted(row["pairs"], np.uint64), docs, best.astype(np.int64)), strict=True):
            part.append(found)
    pairs, docs, best = (np.concatenate(p) for p in parts)
    order = np.argsort(pairs, kind="stable")
    docs, best = docs[order], best[order]
    out = {f.name: [] for f in FOUND}
    for digest, own, times in zip(*[texts.column(c).to_pylist() for c in ("digest", "own", "times")], strict=True):
        at, often = unpack_sorted(own, np.uint32), unpack(times, np.uint32).astype(np.int64)
        row = digest, int(often.sum()), int(best[at] @ often), int(docs[at] @ often)
        for name, value in zip(FOUND.names, row, strict=True):
            out[name].append(value)
    return rows_of(out, FOUND)


def align(
    docs: DataFrame, first: str, second: str, text: str = "text", columns=None, with_groups: bool = False, slot_bytes: int = SLOT
) -> DataFrame:
    """The named columns of docs (all by default) for every row with the seven figures, and with the
    groups themselves if asked for. `first` and `second` are paths of a byte-level tokenizer's JSON
    and of a sentencepiece model on the driver."""
    spark = docs.sparkSession
    ship(spark)
    names = docs.columns if columns is None else list(columns)
    with open(first, encoding="utf-8") as f, open(second, "rb") as g:
        vocabularies = spark.sparkContext.broadcast(f.read()), spark.sparkContext.broadcast(g.read())
    whole = F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    rows = docs.select(digest_of(text).alias("digest"), F.lit(None).cast("long").alias("id"), whole)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = slot_count(size, slot_bytes)
    # Slots are work for the processor more than bytes, so they are not brought together by size.
    texts = text_slots(rows, slots).repartition(min(slots, TASKS), "slot")
    by_slot = texts.groupBy("slot").applyInArrow(holding(*vocabularies, bucket_bits(slots), with_groups), STORED_SQL)
    by_slot = stored(by_slot)
    held = by_slot.filter("bucket is not null").select(*HELD.names)
    aligned = by_slot.filter("digest is not null")
    sums = stored(held.groupBy("bucket").applyInArrow(totals, TOTAL_SQL))
    answers = held.drop("docs").join(sums, "bucket").mapInArrow(told, TOLD_SQL)
    uses = aligned.select("slot", "digest", "own", "times").groupBy("slot")
    figures = uses.cogroup(answers.groupBy("slot")).applyInArrow(counted, FOUND_SQL)
    known = ["digest", "n", "n_a", "n_b", "n_groups", "groups_sha256", *(["groups"] if with_groups else [])]
    figures = stored(aligned.select(*known).join(figures, "digest"))
    slim = stored(docs.select(packed(docs, names), digest_of(text).alias("digest")))
    added = [*ADDED, "groups"] if with_groups else ADDED
    return unpacked(joined_groups(slim, figures, "digest", "n", slim.count()), names, added)

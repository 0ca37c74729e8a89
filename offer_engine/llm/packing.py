"""Packing by lexical retrieval.

Documents are tokenized where they are read. Whole windows of a long document are sequences of
their own; what is left of each document goes to an index shard with documents of like wording.
A shard holds a bounded number of tokens and a BM25 inverted index. A seed document opens a
window, its unused neighbours fill it, best first, and the last one is cut; what was cut off is
the next seed. So only the last window of a shard has padding.

Shards follow two minhashes of a document, of its tokens and its token pairs. Tokens are summed
by 2 ** KEY_BITS keys; runs of small keys share a shard, and a key with too many tokens, as of
many copies, is dealt by hash to as many shards as its tokens need.

Edge cases: a null or empty text is the end token alone. Equal texts and equal rows are packed
each. An empty table gives an empty one. Retrieval only orders; no document is left out.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offer_engine.llm.common import ship, stored

WINDOW = 4096
END = 2
#: Tokens of an index shard.
SHARD_TOKENS = 1 << 19
KEY_BITS = 14
K1, B = 1.2, 0.75
#: Bytes of each generation of chunks and their tokens that a worker remembers, and a chunk's own share.
REMEMBERED = 80_000_000
ENTRY = 150
#: Tokens that a task hands on at once.
BATCH_TOKENS = 1 << 17

PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


@cache
def encoder(vocabulary: str, code: str) -> Callable[[str], bytes]:
    """Token ids of a text under a tokenizer given as JSON, equal to the library's own, as an
    array of the type code.

    For the lower-case BPE whose tokens never reach over white space, chunks between white space
    are encoded once and remembered, and chunks of Latin letters go straight to the BPE model. A
    Latin text is lowered first, which leaves fewer chunks.
    Any other tokenizer encodes whole texts. A worker process keeps the encoder for later tasks.
    """
    import regex
    from tokenizers import Tokenizer

    full = Tokenizer.from_str(vocabulary)
    plan = json.loads(vocabulary)
    kinds = [n["type"] for n in (plan.get("normalizer") or {}).get("normalizers", [])]
    steps = (plan.get("pre_tokenizer") or {}).get("pretokenizers", [])
    by_chunk = (
        kinds == ["NFC", "Replace", "Lowercase"]
        and [s["type"] for s in steps] == ["Split", "ByteLevel"]
        and steps[0]["invert"]
        and r"[^\s" in steps[0]["pattern"]["Regex"]
    )
    if not by_chunk:
        return lambda text: array(code, full.encode(text, add_special_tokens=False).ids).tobytes()
    pieces = regex.compile(steps[0]["pattern"]["Regex"]).findall
    model = full.model
    # Special tokens stand for themselves wherever their text is; it holds no white space.
    contents = [re.escape(t["content"]) for t in plan.get("added_tokens") or []]
    special = re.compile("|".join(contents) or "(?!)").search
    # Byte-level BPE writes bytes as letters: printable ones as themselves, the rest from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    normal = unicodedata.normalize
    beyond = re.compile("[^\x00-\u012f\u0131-\u024f]").search
    latin = re.compile("[!-~\u00a1-\u012f\u0131-\u024f]+").fullmatch
    # Python also splits at four control characters that are no white space here.
    odd = re.compile("[\x1c-\x1f]").search
    space = re.compile("[ \t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+").split
    # Chunks and their pieces, in two generations: what is used moves to the newer one, and when
    # that is full the older one goes.
    size = 0

    class Chunks(dict):
        """Chunks are encoded when they are first asked for."""

        def __missing__(self, chunk: str) -> bytes:
            return remembered(chunk, of_chunk)

    new, old = Chunks(), {}

    def remembered(chunk: str, make: Callable[[str], bytes]) -> bytes:
        nonlocal size
        found = old.get(chunk)
        if found is None:
            found = make(chunk)
        new[chunk] = found
        size += ENTRY + len(chunk) + len(found)
        return found

    def of_piece(piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(letters)
        return array(code, [t.id for t in model.tokenize(piece)]).tobytes()

    def of_chunk(chunk: str) -> bytes:
        if not latin(chunk) or special(chunk):
            return array(code, full.encode(chunk, add_special_tokens=False).ids).tobytes()
        if chunk.isalpha():
            low = chunk.lower()
            return of_piece(low) if low == chunk else new.get(low) or remembered(low, of_piece)
        if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
            found = [chunk[:-1].lower(), chunk[-1]]
        else:
            found = pieces(normal("NFC", chunk).lower())
        if found == [chunk]:
            return of_piece(chunk)
        return b"".join([new.get(p) or remembered(p, of_piece) for p in found])

    def encode(text: str) -> bytes:
        nonlocal new, old, size
        if size > REMEMBERED:
            old, new, size = new, Chunks(), 0
        if text.isascii() or not beyond(text):
            low = text.lower()
            if not special(text) and not special(low):
                text = low
        return b"".join(map(new.__getitem__, space(text) if odd(text) else text.split()))

    return encode


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def lexical_keys(tails: list[np.ndarray]) -> list[int]:
    """Of each document half the bits from the least hash of a token, half from that of a pair."""
    if not tails:
        return []
    half = np.uint64((1 << KEY_BITS // 2) - 1)
    lengths = np.array([len(t) for t in tails])
    first, ids = np.cumsum(lengths) - lengths, np.concatenate(tails).astype(np.uint64)
    one = np.minimum.reduceat(scrambled(ids), first)
    pairs = np.append(scrambled(ids[:-1] << np.uint64(32) | ids[1:]), np.uint64(0))
    pairs[first + lengths - 1] = np.iinfo(np.uint64).max  # no pair begins at a last token
    two = np.where(lengths > 1, np.minimum.reduceat(pairs, first), one)
    top, low = (scrambled(x) >> np.uint64(40) & half for x in (one, two))
    return (top << np.uint64(KEY_BITS // 2) | low).tolist()


def tokenized(vocabulary, window: int, end: int, slim: np.dtype):
    """Rows of texts to rows of tokens: whole windows with their place, the rest with a key."""

    def rows(batches: Iterator[pa.RecordBatch]):
        encode = encoder(vocabulary.value, slim.char)
        closing = array(slim.char, [end]).tobytes()
        part = TaskContext.get().partitionId()
        windows = waiting = 0
        out: list[tuple] = []
        tails: list[np.ndarray] = []

        def flushed():
            keys = iter(lexical_keys(tails))
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            cols.append([next(keys) if number is None else None for number in cols[5]])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32())
            names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "key")
            return pa.RecordBatch.from_pydict(
                {n: pa.array(c, k) for n, c, k in zip(names, cols, kinds, strict=True)}
            )

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.frombuffer(encode(text.as_py() or "") + closing, slim)
                n = len(ids)
                for at in range(0, n - window + 1, window):
                    number = (part << 40 | windows) * 2 + 1
                    windows += 1
                    out.append((doc, at, window, ids[at : at + window].tobytes(), n, number))
                if rest := n % window:
                    tails.append(ids[n - rest :])
                    out.append((doc, n - rest, rest, tails[-1].tobytes(), n, None))
                waiting += n
                if waiting >= BATCH_TOKENS:
                    yield flushed()
                    out.clear()
                    tails.clear()
                    waiting = 0
        yield flushed()

    return rows


class Index:
    """BM25 over the documents of a shard. Terms in more than half of them weigh nothing."""

    def __init__(self, docs: list[np.ndarray]):
        self.n = n = len(docs)
        lengths = np.array([len(d) for d in docs])
        of = np.repeat(np.arange(n, dtype=np.int64), lengths)
        pair, tf = np.unique(np.concatenate(docs).astype(np.int64) * n + of, return_counts=True)
        term, doc = pair // n, pair % n
        _, first, df = np.unique(term, return_index=True, return_counts=True)
        idf = np.maximum(0, np.log((n - df + 0.5) / (df + 0.5)))
        norm = K1 * (1 - B + B * lengths / lengths.mean())
        row = np.repeat(np.arange(len(df)), df)
        self.weight = idf[row] * tf * (K1 + 1) / (tf + norm[doc])
        self.doc, self.first, self.df = doc, first, df
        useful = idf[row] > 0
        by_doc = np.argsort(doc[useful], kind="stable")
        self.terms = row[useful][by_doc]
        self.term_at = np.searchsorted(doc[useful][by_doc], np.arange(n + 1))

    def scores(self, seed: int) -> np.ndarray:
        terms = self.terms[self.term_at[seed] : self.term_at[seed + 1]]
        counts = self.df[terms]
        shift = np.repeat(self.first[terms] - np.cumsum(counts) + counts, counts)
        at = shift + np.arange(len(shift))
        return np.bincount(self.doc[at], self.weight[at], minlength=self.n)


def windows(docs: list[np.ndarray], window: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, first token, tokens), full but for the last one."""
    index, unused = Index(docs), np.ones(len(docs), bool)
    out, seed, begin, next_seed = [], None, 0, 0
    while True:
        if seed is None:
            while next_seed < len(docs) and not unused[next_seed]:
                next_seed += 1
            if next_seed == len(docs):
                return out
            seed, begin = next_seed, 0
        unused[seed] = False
        line = [(seed, begin, len(docs[seed]) - begin)]
        room = window - line[0][2]
        cut = None
        if room and unused.any():
            scores = np.where(unused, index.scores(seed), -1.0)
            for doc in np.argsort(-scores, kind="stable"):
                if not room or not unused[doc]:
                    break
                unused[doc] = False
                taken = min(room, len(docs[doc]))
                line.append((int(doc), 0, taken))
                room -= taken
                if taken < len(docs[doc]):
                    cut = (int(doc), taken)
        out.append(line)
        seed, begin = cut if cut else (None, 0)


def packed_shard(window: int, slim: np.dtype):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "at"], ascending=[False, True], kind="stable")
        docs = [np.frombuffer(x, slim) for x in rows["ids"]]
        ids, start, total = (rows[c].tolist() for c in ("doc_id", "start", "doc_tokens"))
        shard, out = int(rows["shard"].iloc[0]), []
        for number, line in enumerate(windows(docs, window)):
            offset = 0
            for doc, begin, n in line:
                piece = docs[doc][begin : begin + n].astype("<u4").tobytes()
                out.append((ids[doc], start[doc] + begin, n, piece, total[doc], (shard << 20 | number) * 2, offset))
                offset += n
        table = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
        return table.astype({"doc_id": "Int64"})

    return pack


def shards(sums: list[tuple[int, int]], most: int) -> list[tuple[int, int, int]]:
    """(key, first shard, number of shards) from (key, tokens): small neighbours share a shard."""
    out, shard, room = [], 0, most
    for key, tokens in sorted(sums):
        if tokens > most:
            shard += room < most
            parts = -(-tokens // most)
            out.append((key, shard, parts))
            shard, room = shard + parts, most
        else:
            if tokens > room:
                shard, room = shard + 1, most
            out.append((key, shard, 1))
            room -= tokens
    return out


def pack(
    docs: DataFrame,
    vocabulary: str,
    window: int = WINDOW,
    end: int = END,
    shard_tokens: int = SHARD_TOKENS,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id and offset. `vocabulary` is the path of a tokenizer's JSON on the driver."""
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary, encoding="utf-8") as f:
        text_of = f.read()
    from tokenizers import Tokenizer

    size = max(Tokenizer.from_str(text_of).get_vocab_size(), end + 1)
    slim = np.dtype("<u2" if size <= 1 << 16 else "<u4")
    sent = spark.sparkContext.broadcast(text_of)
    kinds = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, key int"
    rows = docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`"))
    tokens = rows.mapInArrow(tokenized(sent, window, end, slim), kinds)
    tokens = stored(tokens.withColumn("at", F.monotonically_increasing_id()))
    whole = tokens.filter("key is null")
    tails = tokens.filter("key is not null")
    sums = tails.groupBy("key").agg(F.sum("length").alias("n")).collect()  # 2 ** KEY_BITS rows
    plan = spark.createDataFrame(
        shards([(r["key"], r["n"]) for r in sums], shard_tokens), "key int, first long, parts int"
    )
    dealt = tails.join(F.broadcast(plan), "key").select(
        "doc_id",
        "start",
        "length",
        "ids",
        "doc_tokens",
        "at",
        (F.col("first") + F.pmod(F.xxhash64("at"), F.col("parts"))).alias("shard"),
    )
    filled = dealt.groupBy("shard").applyInPandas(packed_shard(window, slim), PIECE)

    def widened(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids = [np.frombuffer(x.as_buffer(), slim).astype("<u4").tobytes() for x in batch.column("ids")]
            at = batch.schema.get_field_index("ids")
            yield batch.set_column(at, "ids", pa.array(ids, pa.binary()))

    order = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    whole = whole.withColumn("offset", F.lit(0).cast("long")).select(*order)
    return filled.select(*order).unionByName(whole.mapInArrow(widened, PIECE))


def with_checksum(pieces: DataFrame) -> DataFrame:
    """The pieces with ids_crc32 in place of their ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def crc32(ids) -> int:
    """The checksum of a piece given as numbers."""
    return zlib.crc32(np.asarray(list(ids), "<u4").tobytes())

"""Texts in slots of bounded size that ask hash buckets of bounded size, and are answered.

A slot holds the distinct texts of one hash of their digest. What a slot has to ask of all others
goes to a bucket of the asked value as one packed row, and the answer comes back to the slot as one
packed row. A value, however common, is in a slot's row once, so no bucket grows with a hot text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text of a slot, slots to a bucket, and digests a task remembers.
SLOT_BYTES = 1 << 24
SLOTS_OF_BUCKET = 4
KNOWN = 200_000


def digest_of(text: str) -> Column:
    """32 bytes that stand for a text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256))


def slot_count(bytes_of_text: int, slot_bytes: int = SLOT_BYTES) -> int:
    return max(8, -(-bytes_of_text // slot_bytes))


def bucket_bits(slots: int) -> int:
    """Buckets, as a power of two."""
    return max(3, (slots // SLOTS_OF_BUCKET).bit_length())


def once_a_task(batches: Iterator[pa.RecordBatch]):
    """Rows (digest, id, text) to (digest, id, text, n): a task hands a text on once.

    Later copies add to n, and are handed on without their text where their id is smaller."""
    known: dict[bytes, list] = {}
    kinds = pa.schema([("digest", pa.binary()), ("id", pa.int64()), ("text", pa.string()), ("n", pa.int64())])

    def copies():
        more = [(d, None, None, n) for d, (_, n) in known.items() if n]
        known.clear()
        columns = zip(*more, strict=True) if more else [[] for _ in kinds]
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

    for batch in batches:
        new, kept, at = [], [], batch.schema.get_field_index("text")
        for digest, id_ in zip(batch.column("digest").to_pylist(), batch.column("id").to_pylist(), strict=True):
            found = known.get(digest)
            if found is None:
                known[digest] = [id_, 0]
                new.append(True)
                kept.append(True)
                continue
            less = id_ is not None and (found[0] is None or id_ < found[0])
            if less:
                found[0] = id_
            else:
                found[1] += 1
            new.append(False)
            kept.append(less)
        texts = pc.if_else(pa.array(new, pa.bool_()), batch.column(at).cast(pa.string()), pa.scalar(None, pa.string()))
        ones = pa.array([1] * len(batch), pa.int64())
        out = pa.RecordBatch.from_arrays([batch.column("digest").cast(pa.binary()), batch.column("id"), texts, ones], schema=kinds)
        yield out.filter(pa.array(kept, pa.bool_()))
        if len(known) > KNOWN:
            yield copies()
    yield copies()


def text_slots(rows: DataFrame, slots: int) -> DataFrame:
    """slot, digest, id, text and n from rows of digest, id and text (nowhere null)."""
    slim = rows.select("digest", "id", "text").mapInArrow(once_a_task, "digest binary, id long, text string, n long")
    return slim.withColumn("slot", F.pmod(F.xxhash64("digest"), F.lit(slots)).cast("int"))


def merged(table: pa.Table) -> list[tuple[bytes, int | None, bytes, int]]:
    """(digest, least id, text, n) of each text of a slot, by digest."""
    found: dict[bytes, list] = {}
    columns = table.column("digest"), table.column("id"), table.column("text").cast(pa.binary()), table.column("n")
    for digest, id_, text, n in zip(*[c.to_pylist() for c in columns], strict=True):
        have = found.setdefault(digest, [None, None, 0])
        have[2] += n
        if text is not None:
            have[1] = text
        if id_ is not None and (have[0] is None or id_ < have[0]):
            have[0] = id_
    return [(d, have[0], have[1], have[2]) for d, have in sorted(found.items())]


def pack(values: np.ndarray) -> bytes:
    """Numbers as one plane for each of their bytes, so that high bytes compress away."""
    wide = np.ascontiguousarray(values)
    return np.ascontiguousarray(wide.view(np.uint8).reshape(len(wide), wide.itemsize).T).tobytes()


def unpack(data: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers by their steps."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes, kind) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the known ones, which are ascending."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    return known[np.minimum(at, len(known) - 1)] == values


def rows_of(columns: dict[str, list], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

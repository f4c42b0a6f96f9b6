"""Slices of a corpus: documents that travel and are worked on together, and rows that go to buckets and back to their slice."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Bytes of text of a slice; a longer text is one by itself.
SLICE_BYTES = 4 << 20
#: Kind of the row that holds the texts of a slice; others have larger numbers.
TEXTS = 0
SCHEMA = "slice long, kind int, bucket long, size long, blob binary"
ARROW = pa.schema([("slice", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("size", pa.int64()), ("blob", pa.binary())])


def pack(*columns: np.ndarray, level: int = 1) -> bytes:
    """Columns of any lengths as compressed bytes, the bytes of numbers side by side by their weight."""
    out = []
    for column in columns:
        column = np.ascontiguousarray(column)
        out += [len(column).to_bytes(8, "little"), column.view(np.uint8).reshape(len(column), column.itemsize).T.tobytes()]
    return zstandard.ZstdCompressor(level=level).compress(b"".join(out))


def unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind in kinds:
        n, width = int.from_bytes(raw[at : at + 8], "little"), np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at + 8).reshape(width, n).T).view(kind).ravel())
        at += 8 + n * width
    return out


def ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists of these lengths laid end to end: the list of each entry, and its place there."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


class Slice:
    """Documents whose texts lie end to end."""

    def __init__(self, blob: bytes):
        self.ids, has, lengths, self.data = unpack(blob, "<i8", "u1", "<i8", "u1")
        self.has = has > 0
        self.ends = np.cumsum(lengths)
        self.begins = self.ends - lengths

    @staticmethod
    def blob(ids: list, texts: list[bytes]) -> bytes:
        numbers = np.array([i or 0 for i in ids], dtype="<i8")
        has = np.array([i is not None for i in ids], dtype="u1")
        lengths = np.array([len(t) for t in texts], dtype="<i8")
        return pack(numbers, has, lengths, np.frombuffer(b"".join(texts), np.uint8), level=3)



def bucket_of(keys: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Buckets of keys of so many bits, rising with them."""
    return ((keys >> np.uint64(bits - 32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def cut(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, begin and end of the runs of a sorted array."""
    begins = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    yield from zip(values[begins].tolist(), begins.tolist(), [*begins[1:].tolist(), *[len(values)] * (len(values) > 0)], strict=True)


def rows_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)


def groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, list[dict]]]:
    """The rows of each value of a column of a sorted partition."""
    current, held = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row[column] != current:
                if held:
                    yield current, held
                current, held = row[column], []
            held.append(row)
    if held:
        yield current, held


def cut_slices(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of documents ``doc_id, text``; their names hold the partition. Stored, they are the same for every later step."""
    name = TaskContext.get().partitionId() << 32
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()
        begin, held = 0, 0
        for end, text in enumerate(texts, 1):
            held += len(text)
            if held >= limit or end == len(texts):
                yield rows_of([(name, TEXTS, 0, held, Slice.blob(ids[begin:end], texts[begin:end]))])
                name, begin, held = name + 1, end, 0


def by(rows: DataFrame, name: str) -> DataFrame:
    """Rows of a slice or a bucket together; those of a slice begin with its texts."""
    return rows.repartition(name).sortWithinPartitions(name, "kind", "slice", "bucket")

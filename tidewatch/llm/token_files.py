"""Token-id files: one concatenated id array, document borders as Elias-Fano codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import id_and_text, slices
from tidewatch.llm.tokens import word_tokenizer

#: A segment is closed once it holds this many ids; a document is never cut.
SEGMENT_IDS = 1 << 18
#: Every so many-th border has its bit position stored.
SAMPLE = 256

#: Fixed layout of the file format: one row for each segment of a shard.
FILE_SCHEMA = (
    "shard int, segment int, first_id long, n_docs int, n_ids long, id_bytes int, ids binary, "
    "end_width int, end_low binary, end_high binary, end_samples binary, "
    "n_unnamed int, doc_base long, doc_width int, doc_low binary, doc_high binary, doc_samples binary"
)
DOC_SCHEMA = "shard int, row long, doc_id long, local_start long, n_tokens long, ids binary"


@dataclass
class EliasFano:
    """A rising sequence of numbers from 0 on (equal neighbours allowed), about 2 + log2(largest / n) bits each.

    The lower ``width`` bits of each number lie side by side; the upper bits are unary: number i sets bit
    ``upper + i``. ``samples`` holds the place of every 256th set bit in 32 bits, so ``select`` looks at
    one short stretch.
    """

    n: int
    width: int
    low: bytes
    high: bytes
    samples: bytes

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        width = max(0, (int(values[-1]) // n).bit_length() - 1)
        bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1, dtype=np.uint8)
        high[places] = 1
        samples = places[::SAMPLE].astype("<u4").tobytes()
        return cls(n, width, low, np.packbits(high, bitorder="little").tobytes(), samples)

    def _lower(self, begin: int, end: int) -> np.ndarray:
        if not self.width:
            return np.zeros(end - begin, dtype=np.int64)
        first, last = begin * self.width, end * self.width
        bits = np.unpackbits(
            np.frombuffer(self.low, np.uint8)[first // 8 : -(-last // 8)], bitorder="little"
        )[first % 8 :][: last - first]
        return bits.reshape(-1, self.width).astype(np.int64) @ (1 << np.arange(self.width, dtype=np.int64))

    def select(self, i: int) -> int:
        """Number i, without decoding the others."""
        places = np.frombuffer(self.samples, "<u4")
        at = i // SAMPLE
        begin = int(places[at]) // 8
        end = int(places[at + 1]) // 8 + 1 if at + 1 < len(places) else len(self.high)
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8)[begin:end], bitorder="little")
        ones = np.flatnonzero(bits) + 8 * begin
        ones = ones[ones >= places[at]]
        return ((int(ones[i - at * SAMPLE]) - i) << self.width) | int(self._lower(i, i + 1)[0])

    def decode(self) -> np.ndarray:
        """All numbers."""
        if not self.n:
            return np.zeros(0, dtype=np.int64)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.n]
        return ((ones - np.arange(self.n)) << self.width) | self._lower(0, self.n)


def _encode_shard(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Segments of one shard, whose rows come in order."""
    tokenizer = word_tokenizer(vocabulary)
    width = tokenizer.dtype.itemsize
    end = np.array([end_id], dtype=tokenizer.dtype).tobytes()
    shard, segment, before = TaskContext.get().partitionId(), 0, 0
    docs: list = []
    ids: list[bytes] = []
    held = 0

    def close() -> pa.RecordBatch:
        ends = EliasFano.encode(np.cumsum([len(x) // width for x in ids]))
        named = [doc for doc in docs if doc is not None]
        base = named[0] if named else 0
        names = EliasFano.encode(np.array([doc - base for doc in named], dtype=object).astype(np.uint64))
        return pa.RecordBatch.from_pylist(
            [
                {
                    "shard": shard, "segment": segment, "first_id": before, "n_docs": len(docs), "n_ids": held,
                    "id_bytes": width, "ids": b"".join(ids),
                    "end_width": ends.width, "end_low": ends.low, "end_high": ends.high, "end_samples": ends.samples,
                    "n_unnamed": len(docs) - len(named), "doc_base": base, "doc_width": names.width,
                    "doc_low": names.low, "doc_high": names.high, "doc_samples": names.samples,
                }
            ],
            schema=_FILE_ARROW,
        )

    for doc_ids, texts in slices(batches):
        for doc, encoded in zip(doc_ids, tokenizer.encode(texts), strict=True):
            docs.append(doc)
            ids.append(encoded + end)
            held += len(ids[-1]) // width
            if held >= SEGMENT_IDS:
                yield close()
                before, segment, docs, ids, held = before + held, segment + 1, [], [], 0
    if docs:
        yield close()


_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (field.split() for field in schema.split(", "))])


_FILE_ARROW, _DOC_ARROW = _arrow(FILE_SCHEMA), _arrow(DOC_SCHEMA)


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2) -> None:
    """Encodes every whole text, ends it with ``end_id`` and writes the ids in ascending ``doc_id`` order.

    Rows are range-partitioned by (doc_id, text hash, reading order), so one doc_id may hold any share of the
    rows; each partition becomes a shard of segments. A segment is one row of a Parquet file: the ids as
    2-byte numbers (4-byte ones for a vocabulary over 65,536), the documents' ends and their
    identifiers as Elias-Fano codes. A task holds one segment, that is 2**18 ids and one document at most.

    Null texts are empty and give the end id alone. Null identifiers come first and are stored as a count.
    Rows that share an identifier stand in the order of their text's hash. An empty table writes no segment.
    """
    rows = id_and_text(docs).select(
        "doc_id", "text", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_read")
    )
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "_hash", "_read").sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "_hash", "_read"
    )
    ordered.select("doc_id", "text").mapInArrow(
        lambda batches: _encode_shard(batches, vocabulary, end_id), FILE_SCHEMA
    ).write.option("compression", "zstd").parquet(path)


def _ends(row: dict) -> EliasFano:
    return EliasFano(row["n_docs"], row["end_width"], row["end_low"], row["end_high"], row["end_samples"])


def _names(row: dict) -> list[int | None]:
    named = row["n_docs"] - row["n_unnamed"]
    code = EliasFano(named, row["doc_width"], row["doc_low"], row["doc_high"], row["doc_samples"])
    return [None] * row["n_unnamed"] + [row["doc_base"] + int(x) for x in code.decode()]


def _decode_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of segments, ids as 4-byte little-endian numbers."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ends = _ends(row).decode()
            begins = np.concatenate([[0], ends[:-1]])
            raw = np.frombuffer(row["ids"], "<u2" if row["id_bytes"] == 2 else "<u4").astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["shard"]] * row["n_docs"], pa.int32()),
                    pa.array((row["segment"] << 32) + np.arange(row["n_docs"]), pa.int64()),
                    pa.array(_names(row), pa.int64()),
                    pa.array(row["first_id"] + begins, pa.int64()),
                    pa.array(ends - begins, pa.int64()),
                    pa.array([raw[4 * b : 4 * e] for b, e in zip(begins.tolist(), ends.tolist(), strict=True)], pa.binary()),
                ],
                schema=_DOC_ARROW,
            )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of token files: ``doc_id, start, n_tokens, ids`` (4-byte little-endian).

    ``start`` counts the ids of all documents before. One total for each shard goes to the driver, so as many
    numbers as the files had partitions; segments are decoded where they are read, without a shuffle.
    """
    segments = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = sorted((row.shard, row.total) for row in segments.groupBy("shard").agg(F.sum("n_ids").alias("total")).collect())
    base, before = {}, 0
    for shard, total in totals:
        base[shard], before = before, before + total
    docs = segments.mapInArrow(_decode_segments, DOC_SCHEMA)
    if not base:
        first = F.lit(0)
    else:
        shards = list(base)
        first = F.get(F.lit([base.get(i, 0) for i in range(shards[-1] + 1)]), F.col("shard"))
    return docs.select("doc_id", (first + F.col("local_start")).cast("long").alias("start"), "n_tokens", "ids")


def document_ids(row: dict, i: int) -> np.ndarray:
    """Ids of document ``i`` of a stored segment, by two selects on its border code."""
    ends = _ends(row)
    begin, end = ends.select(i - 1) if i else 0, ends.select(i)
    return np.frombuffer(row["ids"], "<u2" if row["id_bytes"] == 2 else "<u4")[begin:end]

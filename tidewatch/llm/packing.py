"""Packing by lexical retrieval: windows filled with neighbours found in a sharded BM25 index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import id_and_text, slices
from tidewatch.llm.tokens import word_tokenizer
from tidewatch.session import work_dir

WINDOW = 2048
#: Documents of one index shard, and the ids after which a shard is closed before that.
SHARD_DOCS = 512
SHARD_IDS = 1 << 22
#: Ids that are sorted at a time to find the distinct terms of their documents, and the documents this serves at most.
SORT_IDS = 1 << 18
SORT_DOCS = 1 << 16
#: Usual BM25 constants.
K1, B = 1.2, 0.75

TOKEN_SCHEMA = "doc_id long, ids binary, n_ids long, shares binary"
PIECE_SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_TOKEN_ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("n_ids", pa.int64()), ("shares", pa.binary())])
_PIECE_ARROW = pa.schema(
    [(name, pa.binary() if kind == "binary" else pa.int64()) for name, kind in (x.split() for x in PIECE_SCHEMA.split(", "))]
)


def _tokenise(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Ids of documents, and in a row of its own how many documents of the partition hold each id."""
    tokenizer = word_tokenizer(vocabulary)
    end = np.array([end_id], dtype=tokenizer.dtype).tobytes()
    holders = np.zeros(max(tokenizer.tokenizer.get_vocab_size(), end_id + 1), dtype=np.int64)
    docs = 0
    for doc_ids, texts in slices(batches):
        encoded = [raw + end for raw in tokenizer.encode(texts)]
        for part in _parts(encoded, tokenizer.dtype):
            holders += np.bincount(term_table(part)[1], minlength=len(holders))
        docs += len(encoded)
        lengths = [len(raw) // tokenizer.dtype.itemsize for raw in encoded]
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(encoded, pa.binary()), pa.array(lengths, pa.int64()), pa.nulls(len(doc_ids), pa.binary())],
            schema=_TOKEN_ARROW,
        )
    if docs:
        yield pa.RecordBatch.from_pylist(
            [{"doc_id": None, "ids": None, "n_ids": docs, "shares": holders.astype("<i8").tobytes()}], schema=_TOKEN_ARROW
        )


def _parts(encoded: list[bytes], dtype: np.dtype) -> Iterator[list[np.ndarray]]:
    """The ids of documents in runs of about ``SORT_IDS`` ids, so that one sort serves many documents. None is cut or left out."""
    part: list[np.ndarray] = []
    held = 0
    for raw in encoded:
        part.append(np.frombuffer(raw, dtype))
        held += len(part[-1])
        if held >= SORT_IDS or len(part) == SORT_DOCS:
            yield part
            part, held = [], 0
    if part:
        yield part


def term_table(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of documents: document, term and number of occurrences, by document and term."""
    lengths = [len(ids) for ids in docs]
    terms = np.concatenate(docs)
    # Document and term side by side in one number; ids of 2 bytes leave room for as many documents in 4.
    short = terms.dtype.itemsize == 2 and len(docs) <= SORT_DOCS
    kind, bits = (np.uint32, 16) if short else (np.int64, 32)
    keys = np.repeat(np.arange(len(docs), dtype=kind) << kind(bits), lengths) | terms.astype(kind)
    keys.sort()
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    first = np.flatnonzero(new)
    counts = np.diff(first, append=len(keys))
    keys = keys[first]
    return (keys >> kind(bits)).astype(np.int64), (keys & kind((1 << bits) - 1)).astype(np.int64), counts


def distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of one document, rising, and their number of occurrences."""
    _, terms, tf = term_table([ids])
    return terms, tf


def content_keys(
    owner: np.ndarray, terms: np.ndarray, tf: np.ndarray, docs: int, idf: np.ndarray, holders: np.ndarray, least: int
) -> np.ndarray:
    """For each of ``docs`` documents of a ``term_table`` its three heaviest terms that ``least`` documents or more hold, as one number.

    Documents near in it are related. Terms rise, so of equal weights the smallest term comes first.
    """
    keys = np.zeros(docs, dtype=np.int64)
    use = (holders >= least)[terms]
    owner, terms, tf = owner[use], terms[use], tf[use]
    if not len(owner):
        return keys
    weight = idf[terms] * tf * (K1 + 1) / (tf + K1)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    sizes = np.diff(first, append=len(owner))
    found = np.zeros(len(first), dtype=np.int64)
    for _ in range(3):
        heaviest = np.maximum.reduceat(weight, first)
        places = np.flatnonzero(weight == np.repeat(heaviest, sizes))
        best = places[np.searchsorted(places, first)]
        found = found << 21 | np.where(heaviest > -np.inf, terms[best] + 1, 0)
        weight[best] = -np.inf
    keys[owner[first]] = found
    return keys


def content_key(terms: np.ndarray, tf: np.ndarray, idf: np.ndarray, holders: np.ndarray, least: int) -> int:
    """The ``content_keys`` of one document."""
    return int(content_keys(np.zeros(len(terms), dtype=np.int64), terms, tf, 1, idf, holders, least)[0])


def _keys(batches: Iterator[pa.RecordBatch], dtype: str, idf: np.ndarray, holders: np.ndarray, least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [np.zeros(0, dtype=np.int64)]
        for part in _parts(batch.column(1).to_pylist(), np.dtype(dtype)):
            keys.append(content_keys(*term_table(part), len(part), idf, holders, least))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.concatenate(keys), pa.int64())], names=["doc_id", "ids", "key"]
        )


class Shard:
    """An inverted index with BM25 weights over some hundred documents.

    A term's list is a row with a place for each document of the shard. Terms of one document alone have no list: they find no other.
    """

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        owner, term, tf = term_table(docs)
        shared = np.bincount(term, minlength=len(idf)) > 1
        row = np.cumsum(shared) - 1
        use = shared[term]
        owner, term, tf = owner[use], term[use], tf[use]
        length = np.array([len(ids) for ids in docs])[owner]
        scale = K1 * (1 - B + B * length / max(mean_length, 1.0))
        self.lists = np.zeros((int(shared.sum()), len(docs)), dtype=np.float32)
        self.lists[row[term], owner] = idf[term] * tf * (K1 + 1) / (tf + scale)
        self.queries = np.split(row[term], np.searchsorted(owner, np.arange(1, len(docs))))
        self.n = len(docs)

    def scores(self, doc: int) -> np.ndarray:
        """BM25 scores of all documents of the shard for the terms of one of them."""
        return self.lists[self.queries[doc]].sum(axis=0)


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of the shard's documents.

    Whole windows of a long document come first. What remains of each document is packed: the first unused
    document seeds a window, its best unused neighbours by BM25 follow, and the one that reaches the end of the
    window is cut there; its rest seeds the next window. Only the last window of a shard has padding.
    """
    sequence = 0
    start = []
    for i, ids in enumerate(docs):
        whole = len(ids) // window
        for k in range(whole):
            yield i, k * window, window, sequence, 0
            sequence += 1
        start.append(whole * window)
    rest = np.array([len(ids) - begin for ids, begin in zip(docs, start, strict=True)])
    unused = rest > 0
    left = int(unused.sum())
    index = Shard(docs, idf, mean_length)
    seed, first = -1, 0
    while left:
        if seed < 0:
            while not unused[first]:
                first += 1
            seed = first
        ranked: Iterator[int] = iter(())
        if left > 1:
            score = index.scores(seed)
            score[~unused] = -1.0
            score[seed] = -1.0
            # As many neighbours as fill the window, best first; ties by place.
            ranked = iter(np.argsort(-score, kind="stable")[: left - 1].tolist())
        offset, doc, seed = 0, seed, -1
        while True:
            length = min(int(rest[doc]), window - offset)
            yield doc, start[doc], length, sequence, offset
            offset += length
            start[doc] += length
            rest[doc] -= length
            if rest[doc]:
                seed = doc
                break
            unused[doc] = False
            left -= 1
            if offset == window or not left:
                break
            doc = next(ranked)
        sequence += 1


def _pack(batches: Iterator[pa.RecordBatch], dtype: str, idf: np.ndarray, mean_length: float, window: int) -> Iterator[pa.RecordBatch]:
    """Packs a partition shard by shard; the sequence number holds the partition in its upper bits."""
    sequence = TaskContext.get().partitionId() << 40
    names: list = []
    docs: list[np.ndarray] = []
    held = 0

    def close() -> pa.RecordBatch:
        nonlocal sequence, names, docs, held
        pieces = list(pack_shard(docs, idf, mean_length, window))
        which, start, length, number, offset = (np.array(x, dtype=np.int64) for x in zip(*pieces, strict=True))
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([names[i] for i in which], pa.int64()), pa.array(start), pa.array(length),
                pa.array([len(docs[i]) for i in which], pa.int64()), pa.array(sequence + number), pa.array(offset),
                pa.array([docs[i][b : b + n].astype("<u4").tobytes() for i, b, n, _, _ in pieces], pa.binary()),
            ],
            schema=_PIECE_ARROW,
        )
        sequence, names, docs, held = sequence + int(number[-1]) + 1, [], [], 0
        return out

    for batch in batches:
        for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            names.append(name)
            docs.append(np.frombuffer(raw, dtype))
            held += len(docs[-1])
            if len(docs) == SHARD_DOCS or held >= SHARD_IDS:
                yield close()
    if docs:
        yield close()


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """Packs every document into windows of ``window`` ids: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``.

    First pass: tokenise into a table in the shared folder and count, over all documents, how many hold each id
    of the vocabulary (one number for each id of the vocabulary goes to the driver, whatever the input).
    Second pass: a range shuffle by content (``content_key``, then a hash, so that a hot key spreads) brings related
    documents of the whole input together, wherever they lay; each partition cuts its documents into shards of at most 512, builds each shard's inverted
    index with those global weights and packs it (``pack_shard``). A neighbour outside the shard is not returned. The memory of a task
    is one shard beside the sort. Every id lies in exactly one piece; padding occurs in the last window of a shard alone.

    Null and empty texts consist of the end id. Rows repeated in the input are packed each. Null identifiers
    stay null. An empty table gives no pieces. Piece ids are 4-byte little-endian numbers.
    """
    spark = docs.sparkSession
    path = work_dir(spark, "packing-ids")
    id_and_text(docs).mapInArrow(lambda batches: _tokenise(batches, vocabulary, end_id), TOKEN_SCHEMA).write.option(
        "compression", "zstd"
    ).parquet(path)
    tokens = spark.read.schema(TOKEN_SCHEMA).parquet(path)
    tokenizer = word_tokenizer(vocabulary)
    size = max(tokenizer.tokenizer.get_vocab_size(), end_id + 1)
    holders = np.zeros(size, dtype=np.int64)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            for n_docs, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen += np.frombuffer(raw, "<i8")
                n += n_docs
        if n:
            yield pa.RecordBatch.from_pydict(
                {"term": np.flatnonzero(seen), "holders": seen[np.flatnonzero(seen)]}
            )

    counted = tokens.filter("shares IS NOT NULL").select("n_ids", "shares").mapInArrow(add, "term long, holders long")
    for row in counted.groupBy("term").agg(F.sum("holders").alias("holders")).collect():
        holders[row.term] = row.holders
    lengths = tokens.filter("ids IS NOT NULL").agg(F.count("n_ids").alias("docs"), F.sum("n_ids").alias("total")).first()
    idf = np.log1p((lengths.docs - holders + 0.5) / (holders + 0.5))
    mean_length = (lengths.total or 0) / max(lengths.docs, 1)
    dtype = tokenizer.dtype.str
    # A key term has so many holders that its documents can fill a good part of a shard; fewer where the input is small.
    least = max(2, min(SHARD_DOCS // 4, lengths.docs // 50))
    keyed = tokens.filter("ids IS NOT NULL").select("doc_id", "ids").mapInArrow(
        lambda batches: _keys(batches, dtype, idf, holders, least), "doc_id long, ids binary, key long"
    )
    spread = keyed.withColumn("spread", F.xxhash64("doc_id", "ids"))
    related = spread.repartitionByRange("key", "spread").sortWithinPartitions("key", "spread", "doc_id").select("doc_id", "ids")
    return related.mapInArrow(lambda batches: _pack(batches, dtype, idf, mean_length, window), PIECE_SCHEMA)

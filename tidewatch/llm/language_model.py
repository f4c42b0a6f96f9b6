"""Cross-entropy difference of a target and a background bigram model, with exact counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import id_and_text
from tidewatch.llm.slices import SCHEMA, SLICE_BYTES, TEXTS, Slice, bucket_of, by, cut, cut_slices, groups, pack, rows_of, unpack
from tidewatch.llm.words import FACTORS, WordIds, mix
from tidewatch.sources.tables import Scratch

#: Occurrences in the background that make a word one of the vocabulary.
LEAST = 2
#: Weight of the word's own probability in that of a pair.
PRIOR = 4.0
#: Buckets at least, more than tasks, so that these get even shares; and bytes of text whose words and pairs share one, on average, beyond that.
LEAST_BUCKETS = 256
BUCKET_BYTES = 16 << 20
#: Kinds of rows beside the texts of a slice, and the bits of their names. Totals are of a bucket.
WORDS, PAIRS, TOTALS = TEXTS + 1, TEXTS + 2, TEXTS + 3
BITS = {WORDS: 64, PAIRS: 56}


class Bigrams(Slice):
    """A slice with the numbers of its words and of its pairs of neighbouring words; pairs never cross documents."""

    def __init__(self, blob: bytes, words: WordIds):
        super().__init__(blob)
        own = [words.of_bytes(self.data[b:e].tobytes()) for b, e in zip(self.begins.tolist(), self.ends.tolist(), strict=True)]
        self.lengths = np.array([len(x) for x in own], dtype=np.int64)
        ids = np.concatenate(own) if own else np.zeros(0, np.uint64)
        self.doc = np.repeat(np.arange(len(own)), self.lengths)
        #: Places of the words that have one before them in their text.
        self.behind = np.flatnonzero(self.doc[1:] == self.doc[:-1]) + 1
        pairs = mix(ids[self.behind - 1] * FACTORS[0] + ids[self.behind] * FACTORS[1]) >> np.uint64(64 - BITS[PAIRS])
        self.names, self.at = {}, {}
        for kind, hashes in ((WORDS, ids), (PAIRS, pairs)):
            self.names[kind], self.at[kind] = np.unique(hashes, return_inverse=True)

    def counts(self, kind: int, weights: np.ndarray | None = None) -> np.ndarray:
        """Occurrences of each word or pair, or those in documents of weight 1."""
        if weights is not None:
            weights = weights[self.doc if kind == WORDS else self.doc[self.behind]]
        return np.bincount(self.at[kind], weights, minlength=len(self.names[kind])).astype(np.int64)


def _ask(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The distinct words and pairs of each slice by bucket, with how often all its documents and those of the target have them."""
    words = WordIds()
    for name, held in groups(batches, "slice"):
        part = Bigrams(held[0]["blob"], words)
        target = np.zeros(len(part.ids))
        target[held[0]["places"] or []] = 1
        learnt = np.ones(len(part.ids)) if name >= 0 else np.zeros(len(part.ids))
        rows = []
        for kind, bits in BITS.items():
            names, every, mine = part.names[kind], part.counts(kind, learnt), part.counts(kind, target)
            for b, i, j in cut(bucket_of(names, buckets, bits)):
                blob = pack(np.diff(names[i:j], prepend=np.uint64(0)), every[i:j].astype("<u4"), mine[i:j].astype("<u4"))
                rows.append((name, kind, b, j - i, blob))
        if rows:
            yield rows_of(rows)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each slice and bucket, in the order asked: how often the other slices have its words or pairs, and how often the target does.

    And for each bucket: occurrences of words in all documents and in the target, those outside the vocabulary, and its size.
    """
    for bucket, held in groups(batches, "bucket"):
        for kind in BITS:
            own = [row for row in held if row["kind"] == kind]
            if not own:
                continue
            parts = [unpack(row["blob"], "<u8", "<u4", "<u4") for row in own]
            names, at = np.unique(np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in parts]), return_inverse=True)
            every, mine = (np.bincount(at, np.concatenate([x[k] for x in parts]), minlength=len(names)).astype(np.int64) for k in (1, 2))
            if kind == WORDS:
                known = every >= LEAST
                sums = [every.sum(), mine.sum(), every[~known].sum(), mine[~known].sum(), known.sum()]
                yield rows_of([(0, TOTALS, bucket, 0, pack(np.array(sums, dtype="<i8")))])
            begin = 0
            for row, x in zip(own, parts, strict=True):
                mine_at = at[begin : begin + len(x[0])]
                begin += len(x[0])
                blob = pack((every[mine_at] - x[1]).astype("<i8"), mine[mine_at].astype("<i8"))
                yield rows_of([(row["slice"], kind, bucket, row["size"], blob)])


@dataclass
class Difference:
    """Two models, target and background: their totals, and the tables that hold what their documents have.

    ``slices`` are the documents of ``docs`` learnt from, with the places of the target's; ``counts`` the answers to what they asked.
    """

    docs: DataFrame
    scratch: Scratch
    slices: DataFrame
    counts: DataFrame
    buckets: int
    slice_bytes: int
    every: int = 0
    mine: int = 0
    unknown_every: int = 0
    unknown_mine: int = 0
    size: int = 1


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for name, held in groups(batches, "slice"):
        part = Slice(held[0]["blob"])
        place = np.flatnonzero(part.has)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.ids[place]), pa.array(np.full(len(place), name)), pa.array(place.astype(np.int32))], names=["doc_id", "slice", "place"]
        )


def mark_target(slices: DataFrame, labels: DataFrame, label: str, scratch: Scratch) -> DataFrame:
    """Slices with the places of the documents that a label of 1 puts into the target.

    Labels meet the documents' identifiers alone. The places, a few bytes for each document of the target, are written and then
    joined to the slices: Spark sends them to the texts while they are under its broadcast limit, and the other way beyond.
    """
    chosen = labels.filter(F.col(label) == 1).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    members = slices.mapInArrow(_members, "doc_id long, slice long, place int")
    places = members.join(chosen, "doc_id").groupBy("slice").agg(F.collect_list("place").alias("places"))
    return slices.join(scratch.store(places, "target"), "slice", "left").select(*slices.columns, "places")


def _answers(asked: DataFrame, buckets: int, scratch: Scratch) -> DataFrame:
    asks = asked.mapInArrow(lambda batches: _ask(batches, buckets), SCHEMA)
    return scratch.store(by(asks, "bucket").mapInArrow(_add, SCHEMA), "counts")


def train_difference(
    docs: DataFrame, labels: DataFrame, scratch: Scratch, label: str = "quality", slice_bytes: int = SLICE_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> Difference:
    """Background from all documents, target from all documents whose label is 1. The tables live as long as ``scratch``.

    Each slice sends its distinct words and pairs with its counts to buckets by hash, where those of all slices are added up, and
    gets back the totals of what it sent. A word or pair is sent once for each slice, however frequent it is.
    """
    slices = scratch.store(id_and_text(docs).mapInArrow(lambda batches: cut_slices(batches, slice_bytes), SCHEMA), "slices")
    buckets = max(LEAST_BUCKETS, -(-(slices.agg(F.sum("size")).first()[0] or 0) // bucket_bytes))
    marked = mark_target(slices, labels, label, scratch)
    out = Difference(docs, scratch, marked, _answers(marked, buckets, scratch), buckets, slice_bytes)
    for row in out.counts.filter(F.col("kind") == TOTALS).select("blob").toLocalIterator():
        every, mine, unknown_every, unknown_mine, known = unpack(row.blob, "<i8")[0].tolist()
        out.every, out.mine, out.size = out.every + every, out.mine + mine, out.size + known
        out.unknown_every, out.unknown_mine = out.unknown_every + unknown_every, out.unknown_mine + unknown_mine
    return out


def _score(batches: Iterator[pa.RecordBatch], models: tuple[tuple[float, int, int], ...], size: int) -> Iterator[pa.RecordBatch]:
    """Mean difference of the losses of each document's words, from the totals of its slice's words and pairs."""
    words = WordIds()
    for name, held in groups(batches, "slice"):
        part = Bigrams(held[0]["blob"], words)
        totals = {}
        for kind in BITS:
            # Buckets rise with the names, so their answers laid end to end are in the slice's own order.
            found = [unpack(row["blob"], "<i8", "<i8") for row in held if row["kind"] == kind]
            every, mine = (np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
            totals[kind] = every + (part.counts(kind) if name >= 0 else 0), mine
        known = totals[WORDS][0] >= LEAST
        word = part.at[WORDS]
        delta = np.zeros(len(word))
        # Target minus background.
        for sign, total, unknown in models:
            which = 1 if sign > 0 else 0
            own, both = totals[WORDS][which], np.zeros(len(word))
            both[part.behind] = totals[PAIRS][which][part.at[PAIRS]] * known[word[part.behind]]
            before = np.zeros(len(word))
            before[part.behind] = own[word[part.behind - 1]]
            alone = PRIOR * (np.where(known, own, unknown) + 1) / (total + size)
            delta += sign * (np.log(both + alone[word]) - np.log(before + PRIOR))
        sums = np.bincount(part.doc, delta, minlength=len(part.ids))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.ids, mask=~part.has), pa.array(part.lengths),
                pa.array(sums / np.maximum(part.lengths, 1), mask=part.lengths == 0),
            ],
            names=["doc_id", "n_words", "score"],
        )


def score_difference(docs: DataFrame, difference: Difference) -> DataFrame:
    """``doc_id, n_words, score`` of every whole text: mean difference of the two models' losses for each word; above 0 it is more like the target.

    Counts of words and pairs are exact up to clashes of hashes (64 bits for a word, 56 for a pair), and grow with the corpus. Slices of
    documents get the totals of their words and pairs (``train_difference``) and are scored on the spot; documents
    that were not learnt from ask for theirs first. Texts travel compressed, once for the scores.

    Null and empty texts have no words and a null score. Repeated rows and null identifiers keep their rows; a label of an
    identifier puts all its rows into the target. Other columns are not read. An empty table gives no rows.
    """
    d = difference
    slices, counts = d.slices.drop("places"), d.counts.filter(F.col("kind") != TOTALS)
    if docs is not d.docs:
        limit = d.slice_bytes
        others = id_and_text(docs).mapInArrow(lambda batches: cut_slices(batches, limit), SCHEMA)
        # Names below zero tell them from the documents that were learnt from.
        slices = d.scratch.store(others.withColumn("slice", -1 - F.col("slice")), "other-slices")
        asked = d.slices.unionByName(slices.withColumn("places", F.lit(None).cast("array<int>")))
        counts = _answers(asked, d.buckets, d.scratch).filter((F.col("kind") != TOTALS) & (F.col("slice") < 0))
    models, size = ((1.0, d.mine, d.unknown_mine), (-1.0, d.every, d.unknown_every)), d.size
    return by(slices.union(counts), "slice").mapInArrow(
        lambda batches: _score(batches, models, size), "doc_id long, n_words long, score double"
    )

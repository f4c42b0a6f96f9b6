"""Bounded samples of labelled documents to train models on."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import id_and_text


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a row: the crc32 of its identifier as text, modulo ``folds``. A null identifier counts as empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % folds


def hash_below(share: float) -> int:
    """The 64-bit hash below which about this share of all hashes lie."""
    return min(2**63 - 1, int(-(2**63) + min(max(share, 0.0), 1.0) * 2**64))


def fitting(order: list[tuple[int, int, int]], chars: int) -> list[int]:
    """Names of the rows ``(name, label, size)``, in this order, that fit into ``chars`` characters.

    First each class fills its half; what is left then takes rows of either class. Only what is taken counts.
    """
    taken: set[int] = set()
    left = {label: chars // 2 for label in (0, 1)}
    for name, label, size in order:
        if size <= left[label]:
            taken.add(name)
            left[label] -= size
    rest = chars - sum(chars // 2 - x for x in left.values())
    for name, _, size in order:
        if name not in taken and size <= rest:
            taken.add(name)
            rest -= size
    return [name for name, _, _ in order if name in taken]


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int, chars: int) -> DataFrame:
    """``place, doc_id, label, text`` of at most ``rows`` documents for each class and ``chars`` characters in all.

    ``usable`` says, from ``doc_id``, which rows may be learnt from. Those with the smallest hash of the identifier are taken, so the
    sample doesn't depend on how the tables are cut. Each class has half of the characters, and what the other one leaves; a text
    that doesn't fit is skipped, those behind it still enter. Null labels and rows without a document are left out. Of an identifier
    with several labels the smallest counts, of one with several texts the one with the smallest hash, then the smallest.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(usable & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("label").alias("label"))
        .withColumn("place", F.xxhash64("doc_id"))
    )
    # A bound on the hash, twice the share that is wanted, keeps tasks from sending rows that cannot be among the smallest.
    totals = {row.label: row.n for row in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [
        known.filter((F.col("label") == k) & (F.col("place") <= hash_below((2 * rows + 100) / totals.get(k, 1))))
        .orderBy("place", "doc_id")
        .limit(rows)
        for k in (0, 1)
    ]
    found = id_and_text(docs).join(picked[0].union(picked[1]), "doc_id")
    # Lengths come first, and texts only of what fits.
    sizes = found.groupBy("place", "doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), F.length("text").alias("size"))).alias("first"))
    order = sorted(sizes.select("place", "doc_id", "label", "first.size").collect())
    taken = fitting([(row.doc_id, row.label, row.size) for row in order], chars)
    texts = found.filter(F.col("doc_id").isin(taken)).groupBy("place", "doc_id", "label").agg(
        F.min(F.struct(F.xxhash64("text"), "text")).alias("first")
    )
    return texts.select("place", "doc_id", "label", "first.text")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int, chars: int
) -> tuple[list[str], list[int]]:
    """Texts and labels of ``labelled_rows``, on the driver."""
    kept = sorted(labelled_rows(docs, labels, label, usable, rows, chars).collect(), key=lambda row: (row.place, row.doc_id))
    return [row.text for row in kept], [row.label for row in kept]


def train_in_task(sample: DataFrame, train):
    """What ``train(texts, labels)`` makes of a bounded sample, in one task: the driver gets the model alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            labels += batch.column(1).to_pylist()
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(train(texts, labels), pickle.HIGHEST_PROTOCOL)]})

    rows = sample.repartition(1).sortWithinPartitions("place", "doc_id").select("text", "label")
    made = rows.mapInArrow(run, "model binary").first()
    # Without any row there may be no task either.
    return pickle.loads(made.model) if made else train([], [])

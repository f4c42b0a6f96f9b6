"""Quality by nearest-neighbour voting over latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import id_and_text, slices
from tidewatch.llm.samples import labelled_sample
from tidewatch.llm.words import WordIds

#: Labelled documents of each class and characters in all that vote, at most.
VOTERS, VOTER_CHARS = 1500, 16_000_000
#: Terms: hashed pairs of bytes, hashed words, and words that repeat the one before, once for each share of all words that they reach.
PAIR_BITS, WORD_BITS = 12, 12
REPEATED = np.linspace(0.1, 0.8, 16)
WORD_TERMS = (1 << PAIR_BITS) + (1 << WORD_BITS)
TERMS = WORD_TERMS + len(REPEATED)
#: Numbers of a latent vector and neighbours that vote.
RANK, NEIGHBOURS = 48, 25
BLOCK = 512


def term_counts(text: str, words: WordIds) -> np.ndarray:
    """How often each term occurs in a text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    pairs = (raw[:-1] * 2654435761 + raw[1:] * 40503) & 0xFFFFFFFF
    ids = words.of(text)
    counts = np.empty(TERMS, dtype=np.float32)
    counts[: 1 << PAIR_BITS] = np.bincount(pairs >> (32 - PAIR_BITS), minlength=1 << PAIR_BITS)
    counts[1 << PAIR_BITS : WORD_TERMS] = np.bincount((ids >> np.uint64(64 - WORD_BITS)).astype(np.int64), minlength=1 << WORD_BITS)
    repeats = int((ids[1:] == ids[:-1]).sum())
    counts[WORD_TERMS:] = np.where(repeats >= REPEATED * max(len(ids), 1), repeats, 0)
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Term weights of documents, each of length one."""
    weights = np.log1p(counts) * idf
    return weights / np.maximum(np.linalg.norm(weights, axis=1, keepdims=True), 1e-9)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """How many documents hold each term, over all documents; one number for each hashed term reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total, n = WordIds(), np.zeros(TERMS, dtype=np.int64), 0
        for _, texts in slices(batches):
            for text in texts:
                total += term_counts(text, words) > 0
            n += len(texts)
        if n:
            yield pa.RecordBatch.from_pydict({"term": np.arange(-1, TERMS), "holders": np.concatenate([[n], total])})

    out, n = np.zeros(TERMS, dtype=np.int64), 0
    for row in id_and_text(docs).mapInArrow(count, "term long, holders long").groupBy("term").agg(F.sum("holders").alias("n")).collect():
        if row.term < 0:
            n = row.n
        else:
            out[row.term] = row.n
    return out, n


class Voters:
    """Latent vectors of labelled documents."""

    def __init__(self, texts: list[str], labels: list[int], idf: np.ndarray, rank: int = RANK, seed: int = 7):
        self.idf, self.labels = idf.astype(np.float32), np.array(labels, dtype=np.float32)
        words = WordIds()
        rows = np.stack([term_counts(text, words) for text in texts]) if texts else np.zeros((0, TERMS), np.float32)
        matrix = weighted(rows, self.idf)
        rank = max(1, min(rank, len(matrix)))
        # Truncated singular value decomposition by a random start and two rounds of iteration.
        basis = np.random.default_rng(seed).standard_normal((TERMS, rank + 8)).astype(np.float32)
        for _ in range(2):
            basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
        _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
        self.axes = (basis @ right.T)[:, :rank].astype(np.float32)
        self.vectors = self.latent(matrix)

    def latent(self, matrix: np.ndarray) -> np.ndarray:
        flat = matrix @ self.axes
        return flat / np.maximum(np.linalg.norm(flat, axis=1, keepdims=True), 1e-9)

    def scores(self, counts: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest voters: exact cosines to all of them, both classes weighing the same in numbers."""
        share = (float(self.labels.sum()) + 0.5) / (len(self.labels) + 1)
        if not len(self.labels):
            return np.full(len(counts), share)
        cosine = self.latent(weighted(counts, self.idf)) @ self.vectors.T
        k = min(k, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0) ** 4
        votes = (weight * self.labels[near]).sum(1)
        total = weight.sum(1)
        # A hundredth of a vote for the overall share: it decides where nothing is similar.
        return ((votes + 0.01 * share) / (total + 0.01)).astype(float)


def train_quality(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = VOTERS, chars: int = VOTER_CHARS) -> Voters:
    """Voters from a bounded sample of the labelled documents that ``usable`` admits; term statistics from all documents."""
    holders, n = document_frequencies(docs)
    idf = np.log((n + 1) / (holders + 1)) + 1
    return Voters(*labelled_sample(docs, labels, "quality", usable, rows, chars), idf)


def score_quality(docs: DataFrame, voters: Voters) -> DataFrame:
    """``doc_id, score`` of every whole text by its nearest labelled neighbours.

    The voters are broadcast; their size is bounded by the sample. Cosines are computed in blocks of documents,
    against every voter. Null and empty texts have no terms and get the share of label 1 among the voters. Repeated rows and
    null identifiers keep their rows; other columns are not read. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, own = WordIds(), shared.value
        for ids, texts in slices(batches):
            scores = []
            for k in range(0, len(texts), BLOCK):
                counts = np.stack([term_counts(text, words) for text in texts[k : k + BLOCK]])
                scores.append(own.scores(counts))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.concatenate(scores))], names=["doc_id", "score"])

    return id_and_text(docs).mapInArrow(score, "doc_id long, score double")

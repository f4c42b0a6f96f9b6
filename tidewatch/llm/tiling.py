"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import append_columns, whole_text
from tidewatch.llm.words import WordIds, runs, tidy_ids
from tidewatch.sources.tables import stored

#: Words of the shortest tile, and those from which an item may be held in parts; a shorter one has to be held whole.
TILE, ITEM_WORDS = 4, 8
#: Share of an item's words in tiles from which a document counts as contaminated.
COVERAGE = 0.6
#: Characters of benchmark items that are held at a time.
BLOCK_CHARS = 32_000_000

FIELDS = {"coverage": "double", "item_id": "long", "n_items": "long"}


def tiles(doc: np.ndarray, item: np.ndarray, doc_at: np.ndarray, item_at: np.ndarray, least: int = TILE) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(place in the document, place in the item, words)``, longest first, none overlapping another.

    ``doc_at`` and ``item_at`` are the starts of equal runs of ``least`` words. Runs that follow each other on one
    diagonal form a match; the longest unmarked match becomes a tile and its words are marked on both sides, until no unmarked run is left. Ties
    go to the earlier place in the document, then in the item.
    """
    found = []
    order = np.lexsort((doc_at, doc_at - item_at))
    doc_at, item_at = doc_at[order], item_at[order]
    doc_free, item_free = np.ones(len(doc), dtype=np.int64), np.ones(len(item), dtype=np.int64)
    while len(doc_at):
        same = np.flatnonzero(
            np.diff(doc_at - item_at, prepend=np.iinfo(np.int64).min // 2).astype(bool) | (np.diff(doc_at, prepend=-2) != 1)
        )
        length = np.diff(same, append=len(doc_at)) + least - 1
        best = np.lexsort((item_at[same], doc_at[same], -length))[0]
        begin, start, n = int(doc_at[same[best]]), int(item_at[same[best]]), int(length[best])
        found.append((begin, start, n))
        doc_free[begin : begin + n] = 0
        item_free[start : start + n] = 0
        left_doc, left_item = np.concatenate([[0], doc_free.cumsum()]), np.concatenate([[0], item_free.cumsum()])
        whole = (left_doc[doc_at + least] - left_doc[doc_at] == least) & (left_item[item_at + least] - left_item[item_at] == least)
        doc_at, item_at = doc_at[whole], item_at[whole]
    return found


class Benchmark:
    """Items of a benchmark, with how often each occurs, and an index of their runs of ``least`` words by running hash.

    Items under ``item_words`` words are one run of all their words; items without words are left out.
    """

    def __init__(self, items: list[tuple], least: int = TILE, item_words: int = ITEM_WORDS):
        words, self.least = WordIds(), least
        ids = [(item[0], tidy_ids(item[1], words), item[2] if len(item) > 2 else 1) for item in items]
        kept = [x for x in ids if len(x[1]) >= max(item_words, least)]
        self.names, self.items, self.times = [x[0] for x in kept], [x[1] for x in kept], [x[2] for x in kept]
        hashes = [runs(own, least) for own in self.items]
        every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.seeds, first = np.unique(every[order], return_index=True)
        self.begin = np.append(first, len(every))
        self.owner = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes])[order]
        self.place = np.concatenate([np.arange(len(x)) for x in hashes])[order] if hashes else np.zeros(0, np.int64)
        #: By number of words: hash of a short item, the smallest name that has it, and how often it occurs.
        self.short: dict[int, dict[int, tuple[int | None, int]]] = {}
        for name, own, times in ids:
            if 0 < len(own) < max(item_words, least):
                found = self.short.setdefault(len(own), {})
                key = int(runs(own, len(own))[0])
                before = found.get(key, (None, 0))
                found[key] = min((before[0], name), key=_rank), before[1] + times

    def check(self, doc: np.ndarray, threshold: float = COVERAGE) -> tuple[float, int | None, int]:
        """Largest coverage of an item by tiles in the document, that item (ties: the smallest), and the number of items that reach the threshold.

        The words of an item's shared runs bound its coverage. Items are tiled from the largest bound down, as long as one could
        still reach the threshold or be the best.
        """
        best, best_name, n_items = 0.0, None, 0
        for length, found in self.short.items():
            held = {int(x) for x in runs(doc, length)} & found.keys() if len(doc) >= length else ()
            for key in held:
                name, times = found[key]
                n_items += times
                if best < 1.0 or _rank(name) < _rank(best_name):
                    best, best_name = 1.0, name
        if len(doc) < self.least or not len(self.seeds):
            return best, best_name, n_items
        hashes = runs(doc, self.least)
        at = np.minimum(np.searchsorted(self.seeds, hashes), len(self.seeds) - 1)
        doc_at = np.flatnonzero(self.seeds[at] == hashes)
        if not len(doc_at):
            return best, best_name, n_items
        begin, size = self.begin[at[doc_at]], self.begin[at[doc_at] + 1] - self.begin[at[doc_at]]
        flat = np.repeat(begin - np.concatenate([[0], size.cumsum()[:-1]]), size) + np.arange(size.sum())
        owner, place, doc_at = self.owner[flat], self.place[flat], np.repeat(doc_at, size)
        order = np.argsort(owner, kind="stable")
        owner, place, doc_at = owner[order], place[order], doc_at[order]
        cuts = np.flatnonzero(np.diff(owner, prepend=-1))
        able = []
        for first, last in zip(cuts.tolist(), [*cuts[1:].tolist(), len(owner)], strict=True):
            item = self.items[owner[first]]
            covered = np.zeros(len(item) + 1, dtype=np.int64)
            spots = np.unique(place[first:last])
            np.add.at(covered, spots, 1)
            np.add.at(covered, spots + self.least, -1)
            able.append(((covered.cumsum()[:-1] > 0).sum() / len(item), first, last))
        for bound, first, last in sorted(able, reverse=True):
            if bound < min(best, threshold):
                break
            own = owner[first]
            item, name = self.items[own], self.names[own]
            share = sum(n for _, _, n in tiles(doc, item, doc_at[first:last], place[first:last], self.least)) / len(item)
            n_items += self.times[own] * (share >= threshold)
            if share > best or (share == best and share and _rank(name) < _rank(best_name)):
                best, best_name = share, name
        return best, best_name, n_items


def _rank(name: int | None) -> tuple[bool, int]:
    """Orders names, a missing one last."""
    return name is None, name or 0


def mark_contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = COVERAGE, least: int = TILE, item_words: int = ITEM_WORDS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``row, coverage, item_id, n_items, contaminated`` of every document; ``row`` holds its columns.

    Words are compared in lower case without punctuation around them. Shared runs of ``least`` words join a document to items; each pair is tiled
    greedily, and an item whose words lie in tiles by ``threshold`` or more, in whatever order, contaminates the document. An item under
    ``item_words`` words does if the document has all its words in one run. ``coverage`` and ``item_id`` are those of the item covered best, whatever it reaches;
    of items covered alike the smallest identifier, a null one last. 0 and null if no item shares a run.

    The benchmark is worked off in blocks of about ``block_chars`` characters, so what is sent to the tasks has a fixed bound; one pass
    over the documents, without a shuffle, for each block; the number of blocks changes no result. Equal rows of the benchmark travel once and
    count as often as they occur. Items without words never match. Null and empty texts are never contaminated. An empty table of either kind is fine.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), whole_text().alias("text"))
    items = items.groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("times"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    marked = None
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        rows = sorted(((row.item_id, row.text, row.times) for row in part), key=lambda x: (_rank(x[0]), x[1]))
        shared = docs.sparkSession.sparkContext.broadcast(Benchmark(rows, least, item_words))

        def check(batches: Iterator[list[str]], shared=shared) -> Iterator[list[pa.Array]]:
            words = WordIds()
            for texts in batches:
                found = [shared.value.check(tidy_ids(text, words), threshold) for text in texts]
                yield [
                    pa.array([x[0] for x in found], pa.float64()), pa.array([x[1] for x in found], pa.int64()),
                    pa.array([x[2] for x in found], pa.int64()),
                ]

        if marked is None:
            marked = append_columns(docs, check, FIELDS)
        else:
            before = stored(marked.withColumn("text", F.col("row.text")), "tiled")
            after = append_columns(before, check, FIELDS)
            old, name = F.col("row.coverage"), F.col("row.item_id")
            # A null identifier is the last of those covered alike.
            better = (F.col("coverage") > old) | ((F.col("coverage") == old) & F.coalesce(F.col("item_id") < name, name.isNull()))
            marked = after.select(
                F.col("row.row").alias("row"), F.greatest("coverage", old).alias("coverage"),
                F.when(better, F.col("item_id")).otherwise(name).alias("item_id"),
                (F.col("n_items") + F.col("row.n_items")).alias("n_items"),
            )
    return marked.withColumn("contaminated", F.col("n_items") > 0)

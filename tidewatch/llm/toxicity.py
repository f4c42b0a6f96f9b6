"""Toxicity scores of whole documents by a recurrent network over overlapping windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from tidewatch.llm import gru
from tidewatch.llm.common import append_columns
from tidewatch.llm.samples import labelled_rows, train_in_task
from tidewatch.llm.tokens import word_tokenizer

#: Documents of each class and characters in all that the network is trained on, at most.
TRAIN_ROWS, TRAIN_CHARS = 1500, 5_000_000
#: Texts that are scored together.
TEXTS = 500


def train_toxicity(
    docs: DataFrame, labels: DataFrame, usable: Column, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS
) -> gru.Scorer:
    """A network trained, in one task, on a bounded sample of the labelled documents that ``usable`` admits."""
    return train_in_task(labelled_rows(docs, labels, "toxic", usable, rows, chars), gru.train)


def score_toxicity(docs: DataFrame, scorer: gru.Scorer) -> DataFrame:
    """``row, score`` of every document: its columns, and the probability that its strongest window gives.

    One pass without a shuffle; every word but the outermost lies in two windows. The network has a fixed size whatever the
    input. Null and empty texts get the score of a window without words. Repeated rows and null
    identifiers keep their rows; other columns are carried along. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((scorer.network.p, scorer.scale))

    def score(batches: Iterator[list[str]]) -> Iterator[list[pa.Array]]:
        # A worker that tokenised before gives its memory of words back.
        word_tokenizer.cache_clear()
        network = gru.Network.__new__(gru.Network)
        network.p, scale = shared.value
        own = gru.Scorer(network, scale)
        for texts in batches:
            parts = [own.scores(texts[k : k + TEXTS]) for k in range(0, len(texts), TEXTS)]
            yield [pa.array(np.concatenate(parts))]

    return append_columns(docs, score, {"score": "double"})

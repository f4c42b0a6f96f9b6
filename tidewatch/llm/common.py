"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a task works on at a time.
SLICE_BYTES = 2 << 20


def whole_text(name: str = "text") -> Column:
    """The text of a row; a null text counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that other columns are never read and cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def slices(batches: Iterator, limit: int = SLICE_BYTES) -> Iterator[tuple[list, list]]:
    """``(ids, texts)`` of Arrow batches, cut into runs of about ``limit`` bytes.

    The first two columns have to be an id and a text. A text is never cut.
    """
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, rows * limit // max(limit, batch.nbytes))
        for begin in range(0, rows, step):
            part = batch.slice(begin, step)
            yield part.column(0).to_pylist(), part.column(1).to_pylist()


def append_columns(docs: DataFrame, compute, fields: dict[str, str]) -> DataFrame:
    """``row`` (all columns of a document, untouched) and new columns computed from its whole text.

    ``compute`` takes an iterator of lists of texts and gives, for each list, one list for each field. As the old columns
    travel inside ``row``, their names cannot clash with the new ones.
    """
    import pyarrow as pa

    packed = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"), whole_text().alias("text"))
    schema = f"row {packed.schema['row'].dataType.simpleString()}, " + ", ".join(f"{k} {v}" for k, v in fields.items())

    def run(batches: Iterator) -> Iterator:
        waiting = []

        def texts() -> Iterator[list[str]]:
            for batch in batches:
                step = max(1, batch.num_rows * SLICE_BYTES // max(SLICE_BYTES, batch.nbytes)) if batch.num_rows else 1
                for begin in range(0, batch.num_rows, step):
                    part = batch.slice(begin, step)
                    waiting.append(part.column(0))
                    yield part.column(1).to_pylist()

        for columns in compute(texts()):
            yield pa.RecordBatch.from_arrays([waiting.pop(0), *columns], names=["row", *fields])

    return packed.mapInArrow(run, schema)

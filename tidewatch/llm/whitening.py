"""Whitening of embeddings with distributed block matrices."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.sources.tables import Scratch

#: An entry c becomes the whole number floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Components that are kept.
COMPONENTS = 8
#: Entries of a block of centred rows, as a rule (4 MB) and at most, and columns of one.
BLOCK_ENTRIES, MOST_ENTRIES, BLOCK_COLUMNS = 1 << 19, 1 << 23, 1024
#: Blocks whose coordinates Spark's multiplication has on the driver, as long as blocks may grow.
BLOCKS = 100_000
#: Share of all variance below which a component is rounding error.
NOTHING = 1e-12


@dataclass
class Whitening:
    """Vectors ``table`` (``vec_id, deviation, z``), their number, and for each component its share of the variance (None: it has none).

    ``identity_error`` is the largest entry of the whitened vectors' covariance minus the identity, over the components with variance.
    """

    table: DataFrame
    n: int
    explained: list[float | None]
    identity_error: float


def whole_numbers(vector: Column) -> Column:
    """A vector's entries as whole numbers; null where the vector or an entry is null, not finite or too large to be held exactly."""
    held = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double") * SCALE) < 2.0**53, F.lit(False)))
    numbers = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))
    # NaN is larger than any number in Spark's order, so the bound keeps it out as well.
    return F.when(vector.isNotNull() & held, numbers)


def usable_vectors(embeddings: DataFrame, scratch: Scratch) -> tuple[DataFrame, int, int]:
    """``vec_id, x, index`` of all usable vectors of the commonest length (ties: the longer), that length and their number.

    ``index`` counts the rows from 0 without a gap: the place in a stored part, behind the rows of the parts before it.
    """
    found = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(F.col("embedding")).alias("x")).filter("size(x) > 0")
    found = scratch.store(found, "usable")
    common = found.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        return found, 0, 0
    # The number of a row is stored with it: it stays the same however the table is read later.
    placed = scratch.store(found.filter(F.size("x") == common.d).withColumn("place", F.monotonically_increasing_id()), "placed")
    parts = placed.groupBy(F.shiftright("place", 33).cast("int").alias("part")).agg(F.count(F.lit(1)).alias("rows")).orderBy("part").collect()
    before, first = 0, [0] * (parts[-1].part + 1)
    for part, rows in parts:
        first[part], before = before, before + rows
    offset = F.get(F.lit(first), F.shiftright("place", 33).cast("int")).cast("long")
    return placed.select("vec_id", "x", (offset + F.col("place").bitwiseAND((1 << 33) - 1)).alias("index")), common.d, common.n


def dimension_sums(vectors: DataFrame) -> list[int]:
    """Exact sum of each dimension."""
    entries = vectors.select(F.posexplode("x").alias("at", "value"))
    sums = entries.groupBy("at").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("total")).collect()
    return [int(total) for _, total in sorted(sums)]


def _differences(n: int, sums: list[int]) -> Column:
    """n * x - S of each dimension, exact; null where it is beyond a long."""
    return F.zip_with("x", F.lit(sums), lambda x, s: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), x), s.cast("long")))


def block_rows(n: int, d: int) -> int:
    """Rows of a block: 4 MB of entries, more where that would make more than ``BLOCKS`` blocks, up to 64 MB."""
    wide = min(d, BLOCK_COLUMNS)
    return max(1, min(MOST_ENTRIES // wide, max(BLOCK_ENTRIES // wide, -(-n // BLOCKS))))


def _times(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """A product whose inner dimension is dealt to ``splits`` tasks, whose sums are then added up.

    Without it the whole inner dimension of a block of the result would go to one task.
    """
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def _as_table(matrix: BlockMatrix) -> DataFrame:
    """``index, z`` of the rows of a matrix."""
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").cast("long").alias("index"), vector_to_array("vector").alias("z"))


def _identity_error(table: DataFrame, k: int) -> float:
    """The largest absolute entry of the covariance of ``z``'s first ``k`` entries, centred, minus the identity."""
    if not k:
        return 0.0
    means = table.agg(*(F.avg(F.get("z", F.lit(i))).alias(str(i)) for i in range(k))).first()
    centred = [F.get("z", F.lit(i)) - float(means[i]) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    found = table.agg(*(F.avg(centred[i] * centred[j]).alias(f"{i}_{j}") for i, j in pairs)).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(found, pairs, strict=True))


def whiten(embeddings: DataFrame, scratch: Scratch, components: int = COMPONENTS) -> Whitening:
    """Whitens every vector of ``embeddings`` (``vec_id, embedding``) on its leading principal components.

    1. Vectors become whole numbers, get a row index without gaps, and are centred by exact sums: (n * x - S) / n.
    2. The centred rows are indexed into a distributed BlockMatrix. Its transpose times itself, the rows dealt to
       many tasks, is the scatter matrix, dimension x dimension; it goes to the driver, where ``eigh`` decomposes it.
    3. The block matrix times the whitening matrix (eigenvectors over root eigenvalue) projects all rows.

    What the driver holds is one number for each pair of dimensions, each stored part and each block. A vector that is null or empty, holds a null, a
    NaN, an infinity or an entry of 2**53 / 1024 or more is left out, as is one whose length is not the commonest one (ties: the longer).
    Repeated rows and null identifiers count as they are; other columns are not read. Eigenvectors
    have their largest entry (ties: the first) positive. A component without variance has null values. There are at most as many
    components as dimensions. An empty table gives no rows. The returned table lives as long as ``scratch``.
    """
    spark = embeddings.sparkSession
    vectors, d, n = usable_vectors(embeddings, scratch)
    if not n:
        empty = spark.createDataFrame([], "vec_id long, deviation long, z array<double>")
        return Whitening(empty, 0, [], 0.0)
    sums = dimension_sums(vectors)
    k, height, wide = min(components, d), block_rows(n, d), min(d, BLOCK_COLUMNS)
    # The centre as whole and rest keeps the difference exact to a double, however large n * x is.
    whole, rest = [s // n for s in sums], [(s % n) / n for s in sums]
    near = F.zip_with("x", F.lit(whole), lambda x, w: (x - w.cast("long")).cast("double"))
    centred = F.zip_with(near, F.lit(rest), lambda x, r: x - r)
    rows = MLUtils.convertVectorColumnsFromML(vectors.select("index", array_to_vector(centred).alias("vector")), "vector")
    matrix = IndexedRowMatrix(rows, n, d).toBlockMatrix(height, wide)
    splits = max(1, min(-(-n // height), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    scatter = _times(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()
    values, axes = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(k)])
    total = float(np.trace(scatter)) / n
    real = [bool(value > NOTHING * total) for value in values]
    scale = [1 / np.sqrt(value) if ok else 0.0 for value, ok in zip(values, real, strict=True)]
    whitening = axes * scale
    blocks = [
        ((i, 0), Matrices.dense(len(part), k, part.ravel(order="F").tolist()))
        for i, part in enumerate(whitening[b : b + wide] for b in range(0, d, wide))
    ]
    projected = _times(matrix, BlockMatrix(spark.sparkContext.parallelize(blocks, 1), wide, k, d, k), 1)

    deviation = F.aggregate(
        _differences(n, sums), F.lit(0).cast("long"), lambda total, x: F.try_add(total, F.try_multiply(x, x))
    )
    known = vectors.select("vec_id", "index", deviation.alias("deviation"))
    z = F.zip_with("z", F.lit(real), lambda value, ok: F.when(ok, value))
    table = scratch.store(known.join(_as_table(projected), "index").select("vec_id", "deviation", z.alias("z")), "whitened")
    explained = [float(value) / total if ok else None for value, ok in zip(values, real, strict=True)]
    return Whitening(table, n, explained, _identity_error(table, sum(real)))

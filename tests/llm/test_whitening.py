import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidewatch.llm import whitening
from tidewatch.llm.queries import REGISTRY
from tidewatch.sources.tables import Scratch

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k=8):
    """By vec_id in order: deviation, whitened entries; then n and explained shares."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in usable]
    d = max(set(lengths), key=lambda x: (lengths.count(x), x))
    usable = [(i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]) for i, v in usable if len(v) == d]
    n, sums = len(usable), [sum(column) for column in zip(*(x for _, x in usable))]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(x, sums)) for _, x in usable]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for _, x in usable])
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return [i for i, _ in usable], deviation, centred @ axes / np.sqrt(np.maximum(values, 1e-300)), n, values / np.trace(v)


def run(spark, rows, **more):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({"x": F.lit(1), "index": F.lit("a"), "z": F.lit(0), "place": F.lit(2)})
    with Scratch(spark, "test-whitening") as scratch:
        found = whitening.whiten(frame, scratch, **more)
        return found, sorted(found.table.collect(), key=str)


def vectors(n, d, seed=0):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * 0.1
    return [(i, [float(c) for c in row]) for i, row in enumerate(mixed.astype(np.float32))]


def test_query_against_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    names, deviation, z, n, explained = plain(rows)
    out = REGISTRY["op11_embedding_whitening"](spark, DATA)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    by_row = {(r.vec_id, r.component): r for r in out.collect()}
    assert len(by_row) == 8 * len(rows) and {k for _, k in by_row} == set(range(1, 9))
    mine = np.array([[by_row[name, k].whitened for k in range(1, 9)] for name in names])
    assert np.abs(np.abs(mine) - np.abs(z)).max() < 1e-6
    assert np.abs(mine.T @ mine / n - np.eye(8)).max() < 1e-9
    for place, name in enumerate(names):
        row = by_row[name, 3]
        assert (row.n, row.deviation) == (n, deviation[place]) and abs(row.explained / explained[2] - 1) < 1e-9
        assert row.identity_error < 1e-4


def test_odd_vectors_are_left_out_and_others_whole(spark):
    good = vectors(40, 5)
    odd = [
        (100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [float("nan")] * 5), (104, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
        (105, [1.0, 2.0]), (106, [3e38, 0.0, 0.0, 0.0, 0.0]), (None, good[3][1]), (3, good[3][1]), (3, good[4][1]),
    ]
    kept = good + odd[-3:]
    names, deviation, z, n, explained = plain(kept)
    found, rows = run(spark, good + odd)
    assert found.n == n == 43 and len(found.explained) == 5 and found.identity_error < 1e-9
    assert sorted((str(r.vec_id), r.deviation) for r in rows) == sorted(zip(map(str, names), deviation))
    want = sorted((str(i), [round(abs(x), 6) + 0.0 for x in row]) for i, row in zip(names, z.tolist()))
    assert [i for i, _ in want] == sorted(str(r.vec_id) for r in rows)
    mine = sorted((str(r.vec_id), [round(abs(x), 6) + 0.0 for x in r.z]) for r in rows)
    assert all(a[0] == b[0] and np.allclose(a[1], b[1], atol=1e-5) for a, b in zip(want, mine))


def test_without_rows_or_variance(spark):
    for rows in ([], [(1, None)]):
        found, out = run(spark, rows)
        assert (found.n, out, found.explained) == (0, [], [])
    found, out = run(spark, [(i, [0.5, 0.25, float(i % 2)]) for i in range(6)] + [(9, [0.5, 0.25, 1.0])])
    assert [e is None for e in found.explained] == [False, True, True]
    assert all(abs(r.z[0]) > 0 and r.z[1:] == [None, None] for r in out) and found.identity_error < 1e-9
    found, out = run(spark, [(1, [1.0, 2.0])])
    assert found.n == 1 and out[0].z == [None, None] and out[0].deviation == 0


@pytest.mark.parametrize("columns, entries", [(2, 12), (3, 1 << 19)])
def test_many_blocks_both_ways(spark, monkeypatch, columns, entries):
    """Blocks of few rows and columns, so that products are added up over many of them."""
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", columns)
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", entries)
    rows = vectors(100, 7, seed=2)
    names, deviation, z, n, explained = plain(rows)
    found, out = run(spark, rows)
    by_name = {r.vec_id: r for r in out}
    mine = np.array([by_name[i].z for i in names])
    assert np.abs(np.abs(mine) - np.abs(z)).max() < 1e-6 and np.allclose(found.explained, explained)
    assert [by_name[i].deviation for i in names] == deviation


def test_blocks_grow_before_they_are_too_many():
    assert whitening.block_rows(10**4, 64) == 8192
    assert whitening.block_rows(4 * 10**9, 64) == 40_000
    assert whitening.block_rows(4 * 10**12, 64) * 64 == whitening.MOST_ENTRIES
    assert whitening.block_rows(10, 100_000) == 512

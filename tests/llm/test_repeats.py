import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidewatch.llm import repeats
from tidewatch.llm.queries import REGISTRY
from tidewatch.llm.slices import TEXTS, Slice
from tidewatch.sources.tables import Scratch


def plain(rows, length=50):
    """doc_id, n_bytes, removed spans and what stays, from all strings of all documents."""
    data = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, text in data:
        for p in range(len(text) - length + 1) if i is not None else ():
            own = text[p : p + length]
            first[own] = min(first.get(own, i), i)
    out = []
    for i, text in data:
        gone = bytearray(len(text))
        for p in range(len(text) - length + 1) if i is not None else ():
            if first[text[p : p + length]] < i:
                gone[p : p + length] = b"\x01" * length
        spans, p = [], 0
        while (p := gone.find(1, p)) >= 0:
            end = gone.find(0, p)
            spans.append((p, end if end >= 0 else len(text)))
            p = spans[-1][1]
        out.append((i, len(text), spans, bytes(c for c, g in zip(text, gone) if not g)))
    return sorted(out, key=str)


def found(spark, frame, **more):
    with Scratch(spark, "test-repeats") as scratch:
        rows = repeats.remove_repeats(frame, scratch, **more).collect()
        return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in rows), key=str)


def test_query_against_all_strings(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    want = [(i, n, sum(e - b for b, e in s), len(s), hashlib.sha256(k).hexdigest()) for i, n, s, k in plain(docs)]
    assert sorted(map(tuple, REGISTRY["op12_repeated_strings"](spark, DATA).collect()), key=str) == sorted(want, key=str)


def odd_rows():
    draw = random.Random(3)
    words = [draw.randbytes(4).hex() for _ in range(60)]
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(1, 120)))) for i in range(60)]
    rows += [(100 + i, "x" * draw.randint(0, 400)) for i in range(15)] + [(130 + i, "word " * draw.randint(1, 150)) for i in range(15)]
    rows += [(200 + i, rows[i][1][:300] + "Y" + rows[i + 1][1][100:]) for i in range(40)] + [(300 + i, rows[5][1]) for i in range(30)]
    passage = "This passage stands in many documents, each time between other words, and has over fifty bytes. "
    rows += [(400 + i, f"lead {i * 7919} {passage}tail {i * 104729} ünï") for i in range(60)]
    return rows + [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, None), (500, None), (501, "é" * 24), (502, "é" * 25), (503, "é" * 25)]


@pytest.mark.parametrize("more", [{}, {"crowd": 3, "slice_bytes": 20_000, "bucket_bytes": 500}, {"slice_bytes": 500}, {"length": 33}])
def test_odd_texts_slices_and_crowded_keys(spark, corpus, more):
    rows = odd_rows()
    assert found(spark, corpus(rows, parts=4), **more) == plain(rows, more.get("length", 50))


def test_edges(spark, corpus, edges):
    assert found(spark, corpus([])) == []
    assert found(spark, corpus(edges)) == plain(edges)


def test_lengths_that_do_not_fit_are_refused(spark, corpus):
    with pytest.raises(ValueError, match="strings may have"):
        found(spark, corpus([(1, "a")]), length=10)


@given(st.text("ab", min_size=60, max_size=400), st.integers(20, 60))
@settings(max_examples=80, deadline=None)
def test_suffix_buckets_are_equal_strings_in_order(text, length):
    data = np.frombuffer(text.encode(), np.uint8)
    pointer = repeats.suffix_buckets(data, length)
    own = {}
    for p in range(len(text) - length + 1):
        own.setdefault(text[p : p + length], set()).add(int(pointer[p]))
    assert all(len(x) == 1 for x in own.values())
    ranked = [min(own[s]) for s in sorted(own)]
    assert ranked == sorted(set(ranked))


@given(st.binary(min_size=60, max_size=300), st.integers(20, 60))
@settings(max_examples=60, deadline=None)
def test_keys_and_hashes_depend_on_the_bytes_alone(data, length):
    array = np.frombuffer(data, np.uint8)
    hashes = repeats.gram_hashes(array, length)
    assert len(hashes) == len(data) - length + 1
    for p in {0, len(hashes) // 2, len(hashes) - 1}:
        assert hashes[p] == repeats.gram_hashes(array[p : p + length].copy(), length)[0]
    width = min(7, len(hashes))
    assert repeats.least_of(hashes, width).tolist() == [hashes[p : p + width].min() for p in range(len(hashes) - width + 1)]


def test_pieces_hold_every_string_once(spark):
    texts = [t.encode() for _, t in odd_rows() if t]
    part = repeats.Pieces(repeats.Pieces.blob(list(range(len(texts))), texts))
    first, count, key, row = part.runs(50)
    places = sorted(p for f, n in zip(first.tolist(), count.tolist()) for p in range(f, f + n))
    want = [b + p for b, t in zip(part.begins.tolist(), texts) for p in range(len(t) - 49)]
    assert places == want and count.max() <= repeats.PIECE
    by_string = {}
    for f, n, k in zip(first.tolist(), count.tolist(), key.tolist()):
        for p in range(f, f + n):
            by_string.setdefault(part.data[p : p + 50].tobytes(), set()).add(k)
    assert all(len(k) == 1 for k in by_string.values())


def test_whole_plan_has_no_broadcast_of_data(spark, corpus):
    with Scratch(spark, "test-repeats") as scratch:
        out = repeats.remove_repeats(corpus(odd_rows()), scratch)
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and out.select(F.size("spans")).columns


def in_one_bucket(texts, sorted_bytes):
    """What a bucket that has all strings tells the slices, one document each: the rows, and the bytes that were sorted at a time."""
    slices = [repeats.rows_of([(i, TEXTS, 0, len(t), Slice.blob([i], [t]))]) for i, t in enumerate(texts)]
    keys = pa.Table.from_batches(list(repeats._keys(iter(slices), 50, 1)))
    shared = pa.Table.from_batches(list(repeats._meet(iter(keys.to_batches()), 10_000)))
    both = pa.concat_tables([pa.Table.from_batches(slices), shared]).sort_by([("slice", "ascending"), ("kind", "ascending")]).combine_chunks()
    pieces = pa.Table.from_batches(list(repeats._pieces(iter(both.to_batches()), 50, 1)))
    sizes, sort = [], repeats.suffix_buckets
    try:
        repeats.suffix_buckets = lambda data, length: (sizes.append(len(data)), sort(data, length))[1]
        found = list(repeats._refine(iter(pieces.to_batches()), 50, *sorted_bytes))
    finally:
        repeats.suffix_buckets = sort
    rows = []
    for row in pa.Table.from_batches(found).to_pylist() if found else []:
        piece, first, last, doc = repeats.unpack(row["blob"], "<u4", "u1", "u1", "<i8")
        rows += zip([row["slice"]] * len(piece), piece.tolist(), first.tolist(), last.tolist(), doc.tolist(), strict=True)
    return sorted(rows), sizes


def test_a_full_bucket_is_sorted_in_parts():
    """Whatever a bucket holds, a task sorts some of its strings at a time, and the answer is that of sorting all of them."""
    rng = np.random.default_rng(3)
    shared = [rng.integers(97, 123, 700, dtype=np.uint8).tobytes() for _ in range(1200)]
    # The second document ends each passage otherwise, so that keys have several pieces.
    texts = [b"".join(shared), b"".join(x[:400] + bytes([65 + i % 20]) + x[401:] for i, x in enumerate(shared)), b"".join(shared[::-1])]
    whole, _ = in_one_bucket(texts, (1 << 40,))
    parts, sizes = in_one_bucket(texts, (1 << 16,))
    assert parts == whole and len(parts) > 1000
    assert len(sizes) > 5 and max(sizes) < 1 << 17
    assert max(in_one_bucket(texts * 2, ())[1]) <= repeats.SORTED_BYTES + (1 << 17)

import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidewatch.llm import merkle
from tidewatch.llm.queries import REGISTRY
from tidewatch.sources.tables import Scratch


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[k : k + 16]) for k in range(0, len(below), 16)])
    return levels


def plain_proof(levels, i):
    steps = []
    for below in levels[:-1]:
        run = i // 16 * 16
        steps.append((i - run, below[run:i] + below[i + 1 : run + 16]))
        i //= 16
    return steps


def plain_manifest(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of rows (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for row in rows:
        leaf = h(*map(field, row))
        text = row[4]
        if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and text is not None:
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        trees.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf, row[0], h(*map(field, (*row[:4], text)))))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: plain_levels([x[2] for x in sorted(trees[s], key=lambda x: x[:3])]) for s in order}
    top = plain_levels([built[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for i, (_, _, leaf, doc_id, tampered) in enumerate(sorted(trees[s], key=lambda x: x[:3])):
            steps = plain_proof(built[s], i) + plain_proof(top, place)
            node = tampered
            for at, siblings in steps:
                node = h(*siblings[:at], node, *siblings[at:])
            proof = h(*(x for _, siblings in steps for x in siblings))
            out.append((doc_id, leaf, built[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest(spark, frame, levels):
    with Scratch(spark, "test-merkle") as scratch:
        found = merkle.prove_documents(frame, scratch, levels).select(
            "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")), merkle.fold(F.col("tampered"), F.col("proof"))
        )
        return sorted(((*row, row[5] == row[3]) for row in map(tuple, found.collect())), key=str)


def test_query_against_plain_manifest(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select(*merkle.LEAF_COLUMNS).collect()]
    found = REGISTRY["op13_merkle_manifest"](spark, DATA)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=str) == plain_manifest(rows)


@pytest.mark.parametrize("levels", [1, 2])
def test_trees_of_all_sizes_over_many_partitions(spark, levels):
    """Sources of 1, 2, 16, 17, 256, 257 and 700 leaves, a null and an empty one, and over 16 sources."""
    sizes = {None: 5, "": 3, "b": 1, "c": 2, "ä": 16, "d": 17, "e": 256, "f": 257, "hot": 700, **{f"s{i}": 1 for i in range(12)}}
    rows = [
        (1000 * k + i, s, "de" if i % 3 else None, i if i % 4 else None, None if i % 7 == 0 else f"Some Text {i} ß" * (i % 5))
        for k, (s, n) in enumerate(sizes.items()) for i in range(n)
    ]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    frame = spark.createDataFrame(rows, schema).repartition(5).withColumns({"tree": F.lit(1), "idx": F.lit("x"), "leaf": F.lit(0), "root": F.lit(2)})
    assert manifest(spark, frame, levels) == plain_manifest(rows)


def test_edges(spark, edges):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    rows = [(i, None if (i or 0) % 2 else "s", None, None, t) for i, t in edges]
    for some in ([], rows, rows[:1]):
        assert manifest(spark, spark.createDataFrame(some, schema), 1) == plain_manifest(some)


def test_proof_finds_every_change(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"Text {i}") for i in range(100)]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    with Scratch(spark, "test-merkle") as scratch:
        proved = merkle.prove_documents(spark.createDataFrame(rows, schema), scratch)
        proof = F.col("proof")
        kinds = proved.select(
            (merkle.fold(F.col("leaf"), proof) == F.col("root")).alias("same"),
            (merkle.fold(F.sha2(F.lit("other").cast("binary"), 256), proof) == F.col("root")).alias("other"),
            (F.col("tampered") != F.col("leaf")).alias("changed"), (merkle.fold(F.col("tampered"), proof) != F.col("root")).alias("caught"),
        ).collect()
    assert all(r.same and not r.other and r.changed == r.caught for r in kinds) and any(r.changed for r in kinds)


@given(st.integers(1, 600).flatmap(lambda n: st.tuples(st.just(n), st.lists(st.integers(0, n - 1), min_size=1, max_size=40))))
@settings(max_examples=100, deadline=None)
def test_missing_nodes_are_enough_and_none_is_needless(case):
    n, held = case
    levels = plain_levels([str(i) for i in range(n)])
    known = {(0, i) for i in held} | set(merkle.missing(held, n))
    assert len(known) == len(set(held)) + len(merkle.missing(held, n))

    def root(known):
        for level in range(len(levels) - 1):
            for run in range(len(levels[level + 1])):
                if all((level, i) in known for i in range(run * 16, min(run * 16 + 16, len(levels[level])))):
                    known = known | {(level + 1, run)}
        return (len(levels) - 1, 0) in known

    assert root(known)
    assert all(not root(known - {node}) for node in merkle.missing(held, n))

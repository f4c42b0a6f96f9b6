"""Merkle manifest of a dataset, with the proofs of whole leaf partitions fetched at once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.sources.tables import Scratch

#: Children of a node.
ARITY = 16
#: Levels below the root of a leaf partition; it holds ARITY ** LEVELS consecutive leaves of one tree at most.
LEVELS = 3
#: Name of the tree over the subroots; names of the others begin with SOME or are NONE.
TOP, NONE, SOME = "", "n", "s"
#: Columns of a leaf, in order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = "struct<place:int,siblings:array<string>>"
PROOF_SCHEMA = (
    f"doc_id long, leaf string, tampered string, tree string, idx long, subroot string, root string, proof array<{_STEP}>"
)


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column) -> Column:
    """The digest of a row with this text: each field as byte count, colon and value, a null as a dash."""
    return sha256(F.concat(*(_field(text if name == "text" else F.col(name)) for name in LEAF_COLUMNS)))


def tamper(doc_id: Column, text: Column) -> Column:
    """The text, its A-Z lower-cased where 5 divides the crc32 of the identifier; a null identifier has none."""
    chosen = F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(chosen, lower).otherwise(text)


def document_leaves(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, leaf, tampered`` of every document; ``tampered`` is the leaf of the tampered text.

    Trees sort as their sources do, the null source first.
    """
    typed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"),
        F.col("text").cast("string").alias("text"),
    )
    tree = F.coalesce(F.concat(F.lit(SOME), "source"), F.lit(NONE))
    return typed.select(
        tree.alias("tree"), "doc_id", leaf_of(F.col("text")).alias("leaf"),
        leaf_of(tamper(F.col("doc_id"), F.col("text"))).alias("tampered"),
    )


def in_order(leaves: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds ``idx``, a leaf's place in its tree by (doc_id, leaf), and ``n``, the tree's leaves.

    One range shuffle sorts all trees, so a tree with most of the rows runs over many tasks. A leaf's place is that in its stored part,
    plus what the parts before hold of the tree: one row for each part and tree.
    """
    by = [F.col("tree"), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    spread = leaves.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = scratch.store(spread.withColumn("place", F.monotonically_increasing_id()), "in-order")
    part = F.shiftright("place", 33).alias("part")
    held = placed.groupBy("tree", part).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("held"))
    own = Window.partitionBy("tree")
    before = F.sum("held").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    held = held.select(
        "tree", "part", "first", F.coalesce(before, F.lit(0)).cast("long").alias("before"), F.sum("held").over(own).alias("n")
    )
    idx = (F.col("before") + F.col("place") - F.col("first")).alias("idx")
    return placed.withColumn("part", part).join(held, ["tree", "part"]).select(*leaves.columns, idx, "n")


def height(n: int, arity: int = ARITY) -> int:
    """Levels of nodes above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def climb(digests: list[str], levels: int, arity: int = ARITY) -> list[list[str]]:
    """The nodes above consecutive leaves, level by level; the first of them begins a run of every level."""
    out = [digests]
    for _ in range(levels):
        last = out[-1]
        out.append([digest(*last[k : k + arity]) for k in range(0, len(last), arity)])
    return out


def local_levels(n: int, levels: int) -> int:
    """Levels that a leaf partition of a tree of ``n`` leaves has by itself."""
    return min(levels, height(n))


def missing(held: list[int], n: int, arity: int = ARITY) -> list[tuple[int, int]]:
    """The minimal set of nodes ``(level, idx)`` that proves all the leaves ``held`` of a tree of ``n`` leaves.

    A node is derived, and so not fetched, if all its children are held, derived or fetched: going up, only the siblings of what is known
    are missing, each once, however many proofs share it.
    """
    out, known, level = [], sorted(set(held)), 0
    while n > 1:
        have, above = set(known), sorted({i // arity for i in known})
        for run in above:
            out += [(level, i) for i in range(run * arity, min((run + 1) * arity, n)) if i not in have]
        known, n, level = above, -(-n // arity), level + 1
    return out


def leaf_partitions(placed: DataFrame, levels: int, scratch: Scratch) -> DataFrame:
    """``tree, block, n, leaves``: runs of ``ARITY ** levels`` consecutive leaves, in order, each in a row of its own."""
    block = F.floor(F.col("idx") / ARITY**levels).cast("long").alias("block")
    held = placed.groupBy("tree", block).agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("idx", "doc_id", "leaf", "tampered"))).alias("leaves")
    )
    return scratch.store(held, "leaf-partitions")


def _roots(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The root of each leaf partition."""
    for batch in batches:
        sizes, blocks = batch.column("n").to_pylist(), batch.column("block").to_pylist()
        roots = [climb(leaves, local_levels(n, most))[-1][0] for n, leaves in zip(sizes, batch.column("digests").to_pylist(), strict=True)]
        levels = [local_levels(n, most) for n in sizes]
        # A tree as high as its leaf partition ends there; a higher one goes on with nodes of that level.
        yield pa.RecordBatch.from_arrays(
            [batch.column("tree"), batch.column("n"), pa.array(levels, pa.int32()), pa.array(blocks, pa.int64()), pa.array(roots)],
            names=["tree", "n", "level", "idx", "digest"],
        )


def _width(level: Column) -> Column:
    """Nodes that a tree of ``n`` leaves has on a level."""
    return F.ceil(F.col("n") / F.pow(F.lit(float(ARITY)), level))


def upper_nodes(partitions: DataFrame, levels: int, scratch: Scratch) -> DataFrame:
    """``tree, n, level, idx, digest``: the roots of the leaf partitions and every node above, up to each tree's root.

    A level is one grouping by sixteenth; it has a sixteenth of the rows of the one below, so few jobs follow, of quickly falling size.
    """
    light = partitions.select("tree", "block", "n", F.transform("leaves", lambda leaf: leaf["leaf"]).alias("digests"))
    roots = light.mapInArrow(lambda batches: _roots(batches, levels), "tree string, n long, level int, idx long, digest string")
    level = scratch.store(roots, "nodes")
    nodes = level
    top = height(level.agg(F.max("n")).first()[0] or 0)
    for k in range(levels, top):
        # Nodes of a level of which their tree has more than one.
        wide = level.filter(_width(F.lit(k)) > 1)
        runs = wide.groupBy("tree", "n", F.floor(F.col("idx") / ARITY).cast("long").alias("run")).agg(
            F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("nodes")
        )
        joined = F.concat_ws("", F.transform("nodes", lambda node: node["digest"]))
        level = scratch.store(
            runs.select("tree", "n", F.lit(k + 1).alias("level"), F.col("run").alias("idx"), sha256(joined).alias("digest")), "nodes"
        )
        nodes = nodes.unionByName(level)
    return nodes


def tree_roots(nodes: DataFrame) -> DataFrame:
    """``tree, root``: the node of each tree on the level where it has one alone."""
    return nodes.filter(_width(F.col("level")) == 1).select("tree", F.col("digest").alias("root"))


def _wanted(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """For each leaf partition, the coordinates of the nodes that its proofs lack."""
    for batch in batches:
        trees, blocks, levels, places = [], [], [], []
        for tree, block, n in zip(*(batch.column(k).to_pylist() for k in ("tree", "block", "n")), strict=True):
            # All leaves of the partition are held, so every node up to its root is derived.
            for level, idx in missing([block], -(-n // ARITY**most)):
                trees.append(tree)
                blocks.append(block)
                levels.append(level + most)
                places.append(idx)
        yield pa.RecordBatch.from_arrays(
            [pa.array(trees, pa.string()), pa.array(blocks, pa.int64()), pa.array(levels, pa.int32()), pa.array(places, pa.int64())],
            names=["tree", "block", "level", "idx"],
        )


def fetch(partitions: DataFrame, nodes: DataFrame, levels: int) -> DataFrame:
    """``tree, block, fetched``: the missing nodes of every leaf partition, fetched in one join.

    Fifteen nodes at most for each level above the partition; nodes near a root, which many partitions want, are few and their
    join is split where it is skewed.
    """
    wanted = partitions.select("tree", "block", "n").mapInArrow(
        lambda batches: _wanted(batches, levels), "tree string, block long, level int, idx long"
    )
    found = wanted.join(nodes.select("tree", "level", "idx", "digest"), ["tree", "level", "idx"])
    return found.groupBy("tree", "block").agg(F.collect_list(F.struct("level", "idx", "digest")).alias("fetched"))


def expand(n: int, first: int, digests: list[str], fetched: list[dict], most: int = LEVELS) -> Iterator[list[dict]]:
    """The proof of each leaf of a partition, whose shared interiors are derived once.

    A step holds the place of the node in its run and the digests of the others, left to right, from the leaf up.
    """
    levels = local_levels(n, most)
    own = climb(digests, levels)
    above: list[dict] = []
    by_level: dict[int, list[tuple[int, str]]] = {}
    for node in fetched:
        by_level.setdefault(node["level"], []).append((node["idx"], node["digest"]))
    position = first // ARITY**most
    for level in range(most, height(n)):
        run = sorted(by_level.get(level, []))
        above.append({"place": sum(idx < position for idx, _ in run), "siblings": [x for _, x in run]})
        position //= ARITY
    for leaf in range(len(digests)):
        steps, at = [], leaf
        for nodes in own[:levels]:
            run = at // ARITY * ARITY
            steps.append({"place": at - run, "siblings": nodes[run:at] + nodes[at + 1 : run + ARITY]})
            at //= ARITY
        yield steps + above


_PROOF = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.list_(pa.string()))]))
#: Proofs that are handed on together.
TOGETHER = 512


def _expand(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "leaf", "tampered", "tree", "idx", "subroot", "root", "proof"]
    for batch in batches:
        for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
            leaves, rest = row["leaves"], row["top"] or []
            proofs = expand(row["n"], leaves[0]["idx"], [leaf["leaf"] for leaf in leaves], row["fetched"] or [], levels)
            for begin in range(0, len(leaves), TOGETHER):
                part = leaves[begin : begin + TOGETHER]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([leaf["doc_id"] for leaf in part], pa.int64()), pa.array([leaf["leaf"] for leaf in part], pa.string()),
                        pa.array([leaf["tampered"] for leaf in part], pa.string()), pa.array([row["tree"]] * len(part), pa.string()),
                        pa.array([leaf["idx"] for leaf in part], pa.int64()),
                        pa.array([row["subroot"]] * len(part), pa.string()), pa.array([row["root"]] * len(part), pa.string()),
                        pa.array([next(proofs) + rest for _ in part], _PROOF),
                    ],
                    names=names,
                )


def _proved(partitions: DataFrame, nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """Proofs of all leaves; ``above`` has for each tree its ``subroot``, the ``root``, and ``top``, the proof of the one in the other."""
    rows = partitions.join(fetch(partitions, nodes, levels), ["tree", "block"], "left").join(above, "tree")
    return rows.select("tree", "n", "leaves", "fetched", "subroot", "root", "top").mapInArrow(
        lambda batches: _expand(batches, levels), PROOF_SCHEMA
    )


def prove_documents(docs: DataFrame, scratch: Scratch, levels: int = LEVELS) -> DataFrame:
    """The manifest of ``docs`` and the proof of every document: ``doc_id, leaf, tampered, tree, idx, subroot, root, proof``.

    Each row is a leaf. The leaves of a source, in ascending order of doc_id, are the tree of that source; the trees' roots, in
    order of the sources, are the leaves of the top tree, whose root stands for the whole table. ``proof`` holds, from the leaf up
    to that root, the node's place in its run of 16 and the run's other digests; ``fold`` recomputes the root from it.

    Octopus multiproofs: a partition of ``16 ** levels`` consecutive leaves (4,096) computes the minimal union of the nodes that its proofs lack, all
    partitions fetch theirs in one join, and each derives shared interiors once and expands its proofs on the spot. Leaves travel as digests; texts
    are read once, where they lie. A source with most of the rows is many partitions.

    A null in any column counts as such; null identifiers stand first, and rows repeated with an identifier in the order of their
    digests. A null source is a tree of its own, before the others, unlike an empty one. Other columns are not read. An empty table gives no rows.
    The tables live as long as ``scratch``.
    """
    leaves = scratch.store(document_leaves(docs), "leaves")
    partitions = leaf_partitions(in_order(leaves, scratch), levels, scratch)
    nodes = upper_nodes(partitions, levels, scratch)
    subroots = tree_roots(nodes)
    # The top tree is built and proved the same way; its leaves are named by their tree.
    top_leaves = subroots.select(
        F.lit(TOP).alias("tree"), F.col("tree").alias("doc_id"), F.col("root").alias("leaf"), F.lit("").alias("tampered")
    )
    names = scratch.store(in_order(top_leaves, scratch), "top-leaves")
    numbered = names.select("tree", F.col("idx").alias("doc_id"), "leaf", "tampered", "idx", "n")
    top_partitions = leaf_partitions(numbered, levels, scratch)
    top_nodes = upper_nodes(top_partitions, levels, scratch)
    root = tree_roots(top_nodes).select(
        "tree", F.col("root").alias("subroot"), "root", F.lit(None).cast(f"array<{_STEP}>").alias("top")
    )
    top = _proved(top_partitions, top_nodes, root, levels).select("idx", F.col("leaf").alias("subroot"), "root", F.col("proof").alias("top"))
    above = scratch.store(names.select(F.col("doc_id").alias("tree"), "idx").join(top, "idx").drop("idx"), "above")
    return _proved(partitions, nodes, above, levels)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""

    def up(node: Column, step: Column) -> Column:
        left = F.slice(step["siblings"], F.lit(1), step["place"])
        right = F.slice(step["siblings"], step["place"] + 1, F.size(step["siblings"]))
        return sha256(F.concat(F.concat_ws("", left), node, F.concat_ws("", right)))

    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings, from the leaf up, left to right."""
    return sha256(F.concat_ws("", F.flatten(F.transform(proof, lambda step: step["siblings"]))))

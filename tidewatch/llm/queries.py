"""Registered queries of the training-data operators, each ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    content_sort,
    jaccard,
    language_model,
    merkle,
    neighbours,
    packing,
    repeats,
    secrets,
    tiling,
    token_files,
    toxicity,
    url_filter,
    whitening,
)
from tidewatch.llm.samples import fold
from tidewatch.llm.tokens import default_vocabulary
from tidewatch.session import ship_package, work_dir
from tidewatch.sources.tables import Scratch, stored

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build):
    """Registers a query under its function name."""

    @functools.wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return build(spark, sf_dir)

    REGISTRY[build.__name__] = run
    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document lies in the token files, read back from them."""
    path = work_dir(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), path, default_vocabulary(), end_id=2)
    return token_files.read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def packed_pieces(docs: DataFrame) -> DataFrame:
    pieces = packing.pack_documents(docs, default_vocabulary(), end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 ids."""
    return packed_pieces(documents(spark, sf_dir))


#: The rules of the URL filter.
URL_RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
    ("net/fr/", "block"),
]


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's URL."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    import public_tokenizers

    found = secrets.find_secrets(
        documents(spark, sf_dir), default_vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["begin"], x["end"])))

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["kind"] != "random")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share three quarters of their five-word shingles."""
    return jaccard.jaccard_components(documents(spark, sf_dir))


@query
def op6_language_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much more each document is like the good documents than like all, in nats a word."""
    docs = documents(spark, sf_dir)
    with Scratch(spark, "language-model") as scratch:
        models = language_model.train_difference(docs, labels(spark, sf_dir), scratch)
        return stored(language_model.score_difference(docs, models), "language-scores")


@query
def op7_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each document holds an item of the benchmark."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    marked = tiling.mark_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.select("row.doc_id", "coverage", "item_id", "n_items", "contaminated")


@query
def op8_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; the row with the largest doc_id stays."""
    return content_sort.exact_groups(documents(spark, sf_dir))


ORACLE["op5_jaccard_join"] = r"""
WITH RECURSIVE
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= 75 * (any_value(p.n) + any_value(q.n) - count(*))
),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
)
SELECT d.doc_id, coalesce(any_value(z.n), 0) AS n_shingles, min(r.y) AS component_id
FROM documents d JOIN reach r ON r.x = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id
GROUP BY d.doc_id
"""

ORACLE["op8_content_sort"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def judged(scored: DataFrame, folds: int, held_fold: int, from_score: float) -> DataFrame:
    """Scores with the row's fold and the decision."""
    held_out = (fold(F.col("doc_id"), folds) == held_fold).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= from_score).cast("int").alias("predicted"))


#: Folds, the fold that labels aren't learnt from, and the score that decides.
TOXIC_FOLDS, TOXIC_HELD, TOXIC_FROM = 3, 1, 0.7
QUALITY_FOLDS, QUALITY_HELD, QUALITY_FROM = 5, 0, 0.3


def toxicity_scorer(docs: DataFrame, marks: DataFrame):
    return toxicity.train_toxicity(docs, marks, fold(F.col("doc_id"), TOXIC_FOLDS) != TOXIC_HELD)


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, toxicity_scorer(docs, labels(spark, sf_dir))).select("row.doc_id", "score")
    return judged(scored, TOXIC_FOLDS, TOXIC_HELD, TOXIC_FROM)


@query
def op10_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = documents(spark, sf_dir)
    usable = fold(F.col("doc_id"), QUALITY_FOLDS) != QUALITY_HELD
    voters = neighbours.train_quality(docs, labels(spark, sf_dir), usable)
    return judged(neighbours.score_quality(docs, voters), QUALITY_FOLDS, QUALITY_HELD, QUALITY_FROM)


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding on its eight leading principal components, whitened."""
    with Scratch(spark, "whitening") as scratch:
        found = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), scratch)
        explained = F.lit(found.explained).cast("array<double>")
        return stored(
            found.table.select("vec_id", "deviation", F.posexplode("z").alias("place", "whitened")).select(
                "vec_id", (F.col("place") + 1).alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation", "whitened",
                F.get(explained, F.col("place")).alias("explained"), F.lit(found.identity_error).alias("identity_error"),
            ),
            "whitened",
        )


@query
def op12_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the 50-byte strings of smaller documents."""
    with Scratch(spark, "repeats") as scratch:
        found = repeats.remove_repeats(documents(spark, sf_dir), scratch)
        removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["begin"])
        return stored(
            found.select(
                "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                F.sha2("kept", 256).alias("kept_sha256"),
            ),
            "without-repeats",
        )


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether its tampered form still folds to the root."""
    with Scratch(spark, "merkle") as scratch:
        proved = merkle.prove_documents(documents(spark, sf_dir), scratch).select(
            "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
            merkle.fold(F.col("tampered"), F.col("proof")).alias("folded_root"),
        )
        return stored(proved.withColumn("verified", F.col("folded_root") == F.col("root")), "merkle-proofs")


ORACLE["op12_repeated_strings"] = """
WITH
bytes AS (SELECT rowid AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
strings AS (
  SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT r, doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM bytes WHERE doc_id IS NOT NULL AND len(h) >= 100)
),
firsts AS (SELECT s, min(doc_id) AS least FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT r, i FROM strings JOIN firsts USING (s) WHERE least < doc_id),
marked AS (SELECT r, i, coalesce(i > lag(i) OVER w + 50, true) AS opens FROM hits WINDOW w AS (PARTITION BY r ORDER BY i)),
numbered AS (SELECT r, i, sum(opens::INT) OVER (PARTITION BY r ORDER BY i) AS span FROM marked),
spans AS (SELECT r, span, min(i) AS b, max(i) + 50 AS e FROM numbered GROUP BY r, span),
kept AS (
  SELECT s.r, substr(y.h, 2 * coalesce(lag(e) OVER w, 0) + 1, 2 * (b - coalesce(lag(e) OVER w, 0))) AS part, b, e
  FROM spans s JOIN bytes y USING (r) WINDOW w AS (PARTITION BY s.r ORDER BY b)
),
left_over AS (SELECT r, string_agg(part, '' ORDER BY b) AS front, max(e) AS tail, count(*) AS n, sum(e - b) AS gone FROM kept GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN tail IS NULL THEN h ELSE front || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM bytes LEFT JOIN left_over USING (r)
"""


def _merkle_sql(levels: int) -> str:
    """SQL of op13 for trees of up to 16 ** levels leaves; the same steps for the trees of the sources and for the top tree."""

    def field(name: str, value: str | None = None) -> str:
        text = f"({value or name})::VARCHAR"
        return f"coalesce(octet_length(encode({text}))::VARCHAR || ':' || {text}, '-')"

    def climbed(prefix: str) -> list[str]:
        steps = []
        for k in range(levels):
            steps.append(
                f"{prefix}{k + 1} AS (SELECT tree, idx // 16 AS idx, any_value((n + 15) // 16) AS n, sha256(string_agg(digest, '' ORDER BY idx)) AS digest "
                f"FROM {prefix}{k} WHERE n > 1 GROUP BY tree, idx // 16)"
            )
            steps.append(
                f"{prefix}s{k} AS (SELECT a.tree, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l, "
                f"coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r "
                f"FROM {prefix}{k} a JOIN {prefix}{k} b ON b.tree = a.tree AND b.idx // 16 = a.idx // 16 WHERE a.n > 1 GROUP BY a.tree, a.idx)"
            )
        union = " UNION ALL ".join(f"SELECT tree, digest FROM {prefix}{k} WHERE n = 1" for k in range(levels + 1))
        return [*steps, f"{prefix}root AS ({union})"]

    def folded(prefix: str, before: str, columns: str) -> list[str]:
        steps = []
        for k in range(levels):
            source = before if k == 0 else f"{prefix}f{k - 1}"
            steps.append(
                f"{prefix}f{k} AS (SELECT {columns}, f.tree, f.idx // 16 AS idx, proof || coalesce(l || r, '') AS proof, "
                f"CASE WHEN l IS NULL THEN acc ELSE sha256(l || acc || r) END AS acc "
                f"FROM {source} f LEFT JOIN {prefix}s{k} s ON s.tree = f.tree AND s.idx = f.idx)"
            )
        return steps

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = " || ".join(field(name) for name in merkle.LEAF_COLUMNS)
    changed = " || ".join(field(name, lower if name == "text" else None) for name in merkle.LEAF_COLUMNS)
    # DuckDB has no crc32: bit by bit, over the decimal digits, for the rows it is asked of.
    table = "list_reduce([c::UBIGINT] || range(8)::UBIGINT[], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    crc = (
        f"xor(list_reduce([4294967295::UBIGINT] || list_transform(range(len(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, (i + 1)::INT, 1))::UBIGINT), "
        f"lambda c, y: xor(c >> 8, crc_table[(xor(c, y) & 255)::INT + 1])), 4294967295::UBIGINT)"
    )
    parts = [
        f"crcs AS (SELECT list({table} ORDER BY c) AS crc_table FROM range(256) t(c))",
        f"leaves AS (SELECT coalesce('s' || source, 'n') AS tree, doc_id, sha256({leaf}) AS leaf, "
        f"sha256(CASE WHEN coalesce({crc} % 5 = 0, false) THEN {changed} ELSE {leaf} END) AS tampered FROM documents, crcs)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM leaves)",
        "a0 AS (SELECT tree, idx, n, leaf AS digest FROM placed)",
        *climbed("a"),
        "t0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n, digest FROM aroot)",
        "named AS (SELECT tree AS name, row_number() OVER (ORDER BY tree) - 1 AS idx FROM aroot)",
        *climbed("t"),
        "start AS (SELECT doc_id, leaf, tree AS name, tree, idx, '' AS proof, tampered AS acc FROM placed)",
        *folded("a", "start", "doc_id, leaf, name"),
        f"middle AS (SELECT doc_id, leaf, name, '' AS tree, m.idx, proof, acc FROM af{levels - 1} f JOIN named m USING (name))",
        *folded("t", "middle", "doc_id, leaf, name"),
    ]
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, a.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = t.digest AS verified
FROM tf{levels - 1} f JOIN aroot a ON a.tree = f.name CROSS JOIN troot t"""
    )


#: Six levels hold 16,777,216 documents of one source.
ORACLE["op13_merkle_manifest"] = _merkle_sql(6)

"""Exact deduplication by sorting content, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.sources.tables import stored

#: Characters of a text that the sort compares before it turns to the digest.
PREFIX = 32


def normalised(text: Column, lower: bool = False, squeeze: bool = False) -> Column:
    """The bytes that are compared: a null is empty; optionally A-Z folded and white space runs made one space."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    if lower:
        text = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    if squeeze:
        text = F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", " ")
    return text


def _key() -> Column:
    """What a row is sorted by: the first characters, the digest, the identifier; short, whatever the text."""
    return F.struct(F.substring("text", 1, PREFIX).alias("head"), F.col("digest"), F.col("doc_id"))


def splitters(rows: DataFrame, buckets: int) -> list:
    """Sampled keys that cut the sorted rows into about equal buckets; at most ``buckets`` short keys."""
    keys = rows.select(_key().alias("key")).repartitionByRange(buckets, "key")
    firsts = keys.groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("key"))
    return sorted(
        (row.key for row in firsts.collect()),
        key=lambda key: (key.head.encode(), key.digest, key.doc_id is not None, key.doc_id or 0),
    )[1:]


def bucket_of(key: Column, bounds: list) -> Column:
    """How many of the sorted splitters are at most the key, by binary search."""
    if not bounds:
        return F.lit(0)
    table = F.array(
        *(
            F.struct(
                F.lit(bound.head).alias("head"), F.lit(bound.digest).alias("digest"),
                F.lit(bound.doc_id).cast("long").alias("doc_id"),
            )
            for bound in bounds
        )
    )
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))

    def halve(span: Column, _: Column) -> Column:
        middle = ((span["low"] + span["high"]) / 2).cast("int")
        right = F.get(table, middle) <= key
        return (
            F.when(span["low"] >= span["high"], span)
            .when(right, F.struct((middle + 1).alias("low"), span["high"].alias("high")))
            .otherwise(F.struct(span["low"].alias("low"), middle.alias("high")))
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))
    return F.aggregate(steps, start, halve)["low"]


def exact_groups(
    docs: DataFrame, keep: str = "largest", lower: bool = False, squeeze: bool = False, buckets: int | None = None
) -> DataFrame:
    """Groups of equal texts: ``doc_id, keep_id, group_size, kept, text_sha256``, one row per document.

    1. Sampled splitters range-partition the rows by (first characters, digest, identifier); the
       identifier lets a group of copies that is larger than a bucket run over several buckets.
    2. One shuffle moves each text to its bucket, where Spark's external sort puts equals side by side.
    3. Each row's whole text is compared with its neighbour's; a difference begins a new run.
    4. Runs that reach over a bucket's border are joined by comparing the texts at the borders, two rows a bucket.

    Of equal texts the row with the largest (``keep="smallest"``: smallest) identifier stays. Null texts
    are empty texts. A null identifier stays only if its group has no other. Of rows repeated with the
    identifier that stays, exactly one is kept. Other columns are not read. An empty table gives no rows.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be largest or smallest, not {keep!r}")
    text = normalised(F.col("text"), lower, squeeze)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("digest", F.sha2(F.encode("text", "UTF-8"), 256))
    buckets = buckets or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("bucket", bucket_of(_key(), splitters(rows, buckets)))

    order = [F.substring("text", 1, PREFIX), F.col("digest"), F.col("text"), F.col("doc_id").asc_nulls_first()]
    inside = Window.partitionBy("bucket").orderBy(*order)
    before, after = F.lag("text").over(inside), F.lead("text").over(inside)
    marked = rows.select(
        "doc_id", "digest", "bucket", "text",
        F.row_number().over(inside).alias("place"),
        (~F.coalesce(before == F.col("text"), F.lit(False))).alias("opens"),
        before.isNull().alias("first"), after.isNull().alias("last"),
    )
    # Only the rows at the borders carry their text on.
    edge = F.col("first") | F.col("last")
    light = marked.withColumn("edge_text", F.when(edge, F.col("text"))).drop("text")
    run = F.sum(F.col("opens").cast("int")).over(
        Window.partitionBy("bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    )
    runs = stored(light.withColumn("run", run), "content-runs")
    within = Window.partitionBy("bucket", "run")
    sized = runs.select(
        "doc_id", "digest", "bucket", "run", "place",
        F.max("doc_id").over(within).alias("high"), F.min("doc_id").over(within).alias("low"),
        F.count(F.lit(1)).over(within).alias("size"),
        F.max("place").over(within).alias("last_place"), F.min("place").over(within).alias("first_place"),
        F.count("doc_id").over(within).alias("named"),
    )

    chains = _chains(runs, keep)
    joined = sized.join(chains, ["bucket", "run"], "left")
    best = F.col("high") if keep == "largest" else F.col("low")
    keep_id = F.when(F.col("chain_size").isNull(), best).otherwise(F.col("chain_keep"))
    # Nulls sort first, so the row that stays is the last of its run, or the first with an identifier.
    winner = F.col("last_place")
    if keep == "smallest":
        winner = F.least("last_place", F.col("first_place") + F.col("size") - F.col("named"))
    here = F.coalesce(F.col("chain_winner"), F.lit(True))
    return joined.select(
        "doc_id", keep_id.alias("keep_id"),
        F.coalesce("chain_size", "size").alias("group_size"),
        (here & (F.col("place") == winner)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _chains(runs: DataFrame, keep: str) -> DataFrame:
    """Runs that meet at bucket borders: ``bucket, run, chain_keep, chain_size, chain_winner``.

    Reads the first and the last run of each bucket, so the single window over all buckets sorts two
    rows for each.
    """
    touching = runs.filter(F.col("first") | F.col("last")).select("bucket", "run").distinct()
    stats = (
        runs.join(touching, ["bucket", "run"], "left_semi")
        .groupBy("bucket", "run")
        .agg(
            F.max("edge_text").alias("text"), F.count(F.lit(1)).alias("size"),
            F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
        )
    )
    across = Window.orderBy("bucket", "run")
    new = ~F.coalesce(F.lag("text").over(across) == F.col("text"), F.lit(False))
    numbered = stats.select(
        "bucket", "run", "size", "low", "high",
        F.sum(new.cast("int")).over(across.rowsBetween(Window.unboundedPreceding, 0)).alias("chain"),
    )
    chain = Window.partitionBy("chain")
    best = F.max("high").over(chain) if keep == "largest" else F.min("low").over(chain)
    mine = F.col("high") if keep == "largest" else F.col("low")
    holds = mine.eqNullSafe(F.col("chain_keep"))
    return (
        numbered.withColumn("chain_keep", best)
        .withColumn("chain_size", F.sum("size").over(chain))
        .withColumn("chain_winner", F.row_number().over(chain.orderBy(holds.desc(), "bucket", "run")) == 1)
        .select("bucket", "run", "chain_keep", "chain_size", "chain_winner")
    )


def deduplicate_texts(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The documents whose row stays, with all their columns.

    Rows are found again by identifier and text digest; of rows that repeat both, one stays. The columns travel inside one, so
    that none of their names can clash.
    """
    stays = exact_groups(docs, keep).filter("kept").select(_row_key(F.col("text_sha256")).alias("key"))
    digest = F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256)
    keyed = docs.select(_row_key(digest).alias("key"), F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"))
    return keyed.join(stays, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def _row_key(digest: Column) -> Column:
    return F.concat_ws(":", F.col("doc_id").cast("long"), digest)

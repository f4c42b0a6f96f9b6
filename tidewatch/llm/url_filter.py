"""URL verdicts: rules first, boosted trees on lexical features for the rest."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.boosting import Boosted, train
from tidewatch.llm.samples import hash_below

#: Labelled URLs that the trees are trained on, at most. Statistics cover all labelled URLs.
TRAIN_ROWS = 8192
#: Suffix statistics lie in this many hashed bins, so they have a fixed size.
SUFFIX_BINS = 4096
#: Probability from which a URL is blocked.
BLOCK_AT = 0.5
#: Weight of one half in a suffix's rate, so a suffix without labels says nothing.
PRIOR = 5.0


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL. A URL without ``://`` and a null have an empty host and path.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: what follows up to ``?``, ``#`` or the end.
    """
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_match(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule as a struct ``rule, verdict``; null where none fits.

    A rule is ``host/path``. It fits its host and all subdomains where the URL's path starts with the rule's.
    """

    def fits(rule: str) -> Column:
        rule_host, _, rule_path = rule.partition("/")
        return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rule_path)

    # Built from the shortest to the longest, so that the longest is asked first.
    return reduce(
        lambda rest, item: F.when(
            fits(item[0]), F.struct(F.lit(item[0]).alias("rule"), F.lit(item[1]).alias("verdict"))
        ).otherwise(rest),
        sorted(rules, key=lambda item: len(item[0])),
        F.lit(None).cast("struct<rule:string,verdict:string>"),
    )


def suffixes(host: str) -> tuple[str, str]:
    """The last label of a host and the last two."""
    labels = host.rsplit(".", 2)
    return labels[-1], ".".join(labels[-2:])


def suffix_bin(suffix: str) -> int:
    return zlib.crc32(suffix.encode()) % SUFFIX_BINS


def features(url: str, host: str, path: str, rates: np.ndarray, counts: np.ndarray) -> list[float]:
    """Lexical features of a URL: lengths, depth, ratios, entropy, parameters and the statistics of its suffixes."""
    n = len(url)
    bins = [suffix_bin(suffix) for suffix in suffixes(host)]
    query = url.partition("#")[0].partition("?")[2]
    return [
        n, len(host), len(path), path.count("/"),
        sum(c.isdigit() for c in url) / max(n, 1), sum(c.isdigit() for c in host), host.count("-"), host.count("."),
        -sum(k / n * math.log2(k / n) for k in Counter(url).values()),
        len(query.split("&")) if query else 0, len(query), "#" in url,
        *(x for b in bins for x in (rates[b], math.log1p(counts[b]))),
    ]


def suffix_statistics(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Share of blocked URLs and number of URLs of each suffix bin, over all labelled URLs.

    Added up before the shuffle; at most ``SUFFIX_BINS`` rows reach the driver.
    """
    both = F.array(F.substring_index("host", ".", -1), F.substring_index("host", ".", -2))
    bins = (
        labelled.select(F.explode(both).alias("suffix"), "blocked")
        .select(F.expr(f"crc32(encode(suffix, 'UTF-8')) % {SUFFIX_BINS}").alias("bin"), "blocked")
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("blocked"))
        .collect()
    )
    counts, blocked = np.zeros(SUFFIX_BINS), np.zeros(SUFFIX_BINS)
    for row in bins:
        counts[row.bin], blocked[row.bin] = row.n, row.blocked
    return (blocked + PRIOR / 2) / (counts + PRIOR), counts


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str]], train_rows: int = TRAIN_ROWS, block_at: float = BLOCK_AT
) -> DataFrame:
    """Verdicts on URLs: ``page_id, host, path, rule, verdict, score``.

    The longest fitting rule decides. URLs with a rule are the labelled ones: suffix statistics count all of
    them, and the trees learn from at most ``train_rows`` of them, those with the smallest hash of id and URL. A URL without a
    rule is blocked when the trees' probability (``score``) is ``block_at`` or more.

    A null URL and one without ``://`` have an empty host and path and are judged by the trees. A rule such as ``com/`` wants a path
    that begins with a slash: ``http://a.com``, whose path is empty, fits none and is judged by the trees too. Without
    labelled URLs the trees say one half, which blocks at the default threshold. Repeated rows and null
    identifiers keep their rows; other columns are not read. An empty table gives no rows.
    """
    host, path = url_parts(F.col("url"))
    urls = pages.select(F.col("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    urls = urls.withColumn("host", host).withColumn("path", path)
    urls = urls.withColumn("found", rule_match(F.col("host"), F.col("path"), rules))
    labelled = urls.filter("found IS NOT NULL").select(
        "url", "host", "path", (F.col("found.verdict") == "block").cast("int").alias("blocked"),
        F.xxhash64("page_id", "url").alias("place"),
    )
    rates, counts = suffix_statistics(labelled)
    # The last label and the last two of each labelled URL were counted. Only rows that can be in the sample leave their task.
    bound = hash_below((2 * train_rows + 100) / max(1.0, counts.sum() / 2))
    sample = labelled.filter(F.col("place") <= bound).orderBy("place", "url").limit(train_rows).collect()
    x = [features(row.url, row.host, row.path, rates, counts) for row in sample]
    model: Boosted = train(np.array(x, dtype=float), np.array([row.blocked for row in sample], dtype=float))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_pylist() for k in (1, 2, 3)]
            x = np.array([features(*parts, rates, counts) for parts in zip(*columns, strict=True)], dtype=float)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in (0, 2, 3, 4, 5)), pa.array(model.probability(x))],
                names=["page_id", "host", "path", "rule", "given", "score"],
            )

    flat = urls.select("page_id", "url", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("given"))
    kind = dict(flat.dtypes)["page_id"]
    scored = flat.mapInArrow(score, f"page_id {kind}, host string, path string, rule string, given string, score double")
    by_trees = F.when(F.col("score") >= block_at, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("given", by_trees).alias("verdict"), "score")

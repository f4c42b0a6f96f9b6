"""Regular time series: gap filling and rolling baselines.

Rows here are windows, not events. A series still may be long, and one series may hold most
rows, so nothing below orders a whole series in one task: rows carry a dense position, the
positions are cut into blocks, and the end of each block is copied in front of the next one.
A rolling frame then never needs more than its own block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.config import DetectorConfig, micros
from tidewatch.functions.baseline import WIDE
from tidewatch.functions.measures import cents, floor_div

ALL = "all"
BLOCK = 1024


def with_series(metrics: DataFrame, *keys: str) -> DataFrame:
    """Adds the ``series`` name: the given key columns, or one series for everything.

    Different keys never share a name: ``|`` separates keys, inside a key it becomes ``\\p``, a backslash two, and a
    null is ``\\0``.
    """
    parts = [
        F.coalesce(F.replace(F.replace(F.col(key).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\p")), F.lit("\\0"))
        for key in keys
    ]
    return metrics.withColumn("series", F.concat_ws("|", *parts) if parts else F.lit(ALL))


def segment_spans(series: DataFrame, step: str, gap: str | None = None, until: Column | None = None) -> DataFrame:
    """``series, segment, first, steps``: the stretches of each series without a hole longer than ``gap``, and how many steps they are filled.

    A segment that another one follows is filled up to ``gap`` behind its last window, the last one up to ``until``, if that is given
    and not further away. Only the first and last window of every stretch of ``gap`` are put in order: two windows of one
    stretch are never further apart than ``gap``, so a series takes few rows here, however many windows it has.
    """
    stride, start = micros(step), F.unix_micros("window_start")
    if gap is None:
        last = F.max(start) if until is None else F.greatest(F.max(start), F.unix_micros(until))
        spans = series.groupBy("series").agg(F.min(start).alias("first"), last.alias("end"))
        spans = spans.withColumn("segment", F.lit(1).cast("long"))
    else:
        limit = micros(gap)
        stretches = series.groupBy("series", floor_div(start, limit).alias("stretch")).agg(
            F.min(start).alias("first"), F.max(start).alias("last")
        )
        own = W.partitionBy("series").orderBy("stretch")
        opens = F.coalesce(F.col("first") - F.lag("last").over(own) > limit, F.lit(True))
        segments = (
            stretches.withColumn("opens", opens.cast("long"))
            .withColumn("segment", F.sum("opens").over(own.rowsBetween(W.unboundedPreceding, 0)))
            .groupBy("series", "segment").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        )
        followed = F.lead("segment").over(W.partitionBy("series").orderBy("segment")).isNotNull()
        wanted = F.col("last") if until is None else F.greatest(F.col("last"), F.unix_micros(until))
        bound = F.col("last") + limit
        spans = segments.withColumn("end", F.when(followed, bound).otherwise(F.least(wanted, bound)))
    return spans.select("series", "segment", "first", F.call_function("div", F.col("end") - F.col("first"), F.lit(stride)).alias("steps"))


def fill_gaps(
    series: DataFrame,
    step: str,
    measures: tuple[str, ...] = ("event_count", "revenue", "active_users"),
    until: Column | None = None,
    block: int = BLOCK,
    gap: str | None = DetectorConfig.longest_gap,
) -> DataFrame:
    """One row per ``step`` from the first to the last window of each segment of each series.

    Windows without a row get zeros. ``window_no`` counts the windows of a segment from 1.
    ``until`` extends every series to that window start, so a series that fell silent keeps
    getting zero rows. A hole longer than ``gap`` ends a ``segment``; it is filled for that long only, so that one date far off
    adds two short segments and not the windows of all years between. None fills every hole.
    """
    stride = micros(step)
    spans = segment_spans(series, step, gap, until)
    # Two short explodes instead of one array with a whole series in it.
    spine = (
        spans.withColumn("lead", F.explode(F.sequence(F.lit(0).cast("long"), "steps", F.lit(block).cast("long"))))
        .withColumn(
            "position",
            F.explode(F.sequence("lead", F.least(F.col("lead") + (block - 1), F.col("steps")))),
        )
        .select(
            "series",
            (F.col("first") + F.col("position") * stride).alias("start"),
            "segment",
            (F.col("position") + 1).alias("window_no"),
            *(F.lit(0).cast(series.schema[name].dataType).alias(name) for name in measures),
        )
    )
    none = F.lit(None).cast("long")
    known = series.select(
        "series", F.unix_micros("window_start").alias("start"), none.alias("segment"), none.alias("window_no"), *measures
    )
    return (
        spine.unionByName(known)
        .groupBy("series", "start")
        .agg(F.max("segment").alias("segment"), F.max("window_no").alias("window_no"), *(F.sum(name).alias(name) for name in measures))
        .withColumn("window_start", F.timestamp_micros("start"))
        .drop("start")
    )


def _add_baseline(
    rows: DataFrame, name: str, measure: str, positive: bool, ordinal: str, size: int, block: int
) -> DataFrame:
    """Adds the baseline ``name`` over the ``size`` samples before each row of its series.

    Samples are all values of ``measure`` or only the positive ones, and ``ordinal`` is the
    number of samples before the row. Rows are cut into blocks of ordinals, and the last
    samples of a block are copied into the next. ``block`` stays as a column.
    """
    if block < size:
        raise ValueError("a block must be at least as long as the baseline")
    home = floor_div(F.col(ordinal), block)
    own = F.struct(home.alias("block"), F.lit(False).alias("copied"))
    ahead = F.struct((home + 1).alias("block"), F.lit(True).alias("copied"))
    value = F.col(measure)
    carried = F.pmod(F.col(ordinal), F.lit(block)) >= block - size
    if positive:
        carried, value = carried & (value > 0), F.when(value > 0, value)
    wide = value.cast(WIDE)
    frame = W.partitionBy("series", "segment", "block").orderBy(ordinal).rangeBetween(-size, -1)
    return (
        rows.select(
            "*",
            value.alias("_value"),
            (wide * wide).cast(WIDE).alias("_square"),
            F.inline(F.when(carried, F.array(own, ahead)).otherwise(F.array(own))),
        )
        .select(
            *rows.columns,
            "block",
            "copied",
            F.count("_value").over(frame).alias(f"{name}_n"),
            F.sum("_value").over(frame).alias(f"{name}_sum"),
            F.sum("_square").over(frame).cast(WIDE).alias(f"{name}_squares"),
        )
        .filter("NOT copied")
        .drop("copied")
    )


# Baselines that only sample windows above zero, and their measures.
POSITIVE_ONLY = {"revenue": "revenue_cents", "users": "active_users"}


def with_baselines(
    filled: DataFrame,
    size: int = DetectorConfig.window_size,
    names: tuple[str, ...] = ("revenue", "users"),
    block: int = BLOCK,
) -> DataFrame:
    """Adds the baseline ``count`` and those in ``names`` to a gap-free series.

    Each covers the ``size`` samples before the row. Counts sample every window, also empty
    and unusual ones; revenue and users only the windows where they are above zero.

    ``filled`` is read twice, so it should come from a stored table (``tables.stored``).
    """
    block = max(block, size)
    rows = filled.withColumns({"revenue_cents": cents("revenue"), "ordinal": F.col("window_no") - 1})
    out = _add_baseline(rows, "count", "event_count", False, "ordinal", size, block)
    if not names:
        return out.drop("ordinal", "block")

    # Samples before a row: those of all earlier blocks plus the earlier ones of its block.
    earlier_blocks = W.partitionBy("series", "segment").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    earlier_rows = W.partitionBy("series", "segment", "block").orderBy("ordinal").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")

    def positive(name: str) -> Column:
        return F.count_if(F.col(POSITIVE_ONLY[name]) > 0)

    before = (
        rows.groupBy("series", "segment", floor_div(F.col("ordinal"), block).alias("block"))
        .agg(*(positive(name).alias(name) for name in names))
        .select(
            "series", "segment", "block",
            *(F.coalesce(F.sum(name).over(earlier_blocks), zero).alias(f"{name}_before") for name in names),
        )
    )
    kept = [name for name in out.columns if name not in ("block", "ordinal")]
    out = out.join(before, ["series", "segment", "block"]).select(
        *kept,
        *(
            (F.col(f"{name}_before") + positive(name).over(earlier_rows)).alias(f"{name}_ordinal")
            for name in names
        ),
    )
    for name in names:
        ordinal = f"{name}_ordinal"
        out = _add_baseline(out, name, POSITIVE_ONLY[name], True, ordinal, size, block)
        out = out.drop("block", ordinal)
    return out


def latest_samples(
    filled: DataFrame, column: str, name: str, size: int, positive: bool = False
) -> DataFrame:
    """The baseline ``name`` after the last window, one row per series: that of its last segment with samples."""
    rows = filled.filter(F.col(column) > 0) if positive else filled
    newest = W.partitionBy("series").orderBy(F.desc("segment"), F.desc("window_no"))
    wide = F.col(column).cast(WIDE)
    return (
        rows.select("series", "segment", "window_no", column)
        .withColumn("age", F.row_number().over(newest))
        .filter(F.col("age") <= size)
        .groupBy("series", "segment")
        .agg(
            F.count(column).alias(f"{name}_n"),
            F.sum(column).alias(f"{name}_sum"),
            F.sum((wide * wide).cast(WIDE)).cast(WIDE).alias(f"{name}_squares"),
        )
        .groupBy("series")
        .agg(F.max_by(F.struct(f"{name}_n", f"{name}_sum", f"{name}_squares"), "segment").alias("newest"))
        .select("series", "newest.*")
    )

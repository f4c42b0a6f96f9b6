"""Event-time window metrics, the same functions for tables and streams.

No operator uses ``countDistinct``: a stream refuses it. An exact distinct count is two
aggregations instead, (window, key) and then (window). Both combine rows before their
shuffle, so a busy window or a busy user is spread over all tasks, and what reaches a single
task is at most one partial row per upstream task and window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.config import SLIDING_COUNT_TYPES, WindowConfig, micros
from tidewatch.functions.measures import (
    count_name,
    count_of,
    finite,
    floor_div,
    mean_money,
    money,
    parts,
    revenue_parts,
    sum_of_parts,
    whole_cents,
)
from tidewatch.operators.dedupe import with_delay
from tidewatch.schema import DEVICE_COLUMNS, PAGE_COLUMNS, REVENUE_COLUMNS, SLIDING_COLUMNS, TUMBLING_COLUMNS

# Buckets that the users of a streamed sliding window are dealt to.
USER_BUCKETS = 32
# Windows of a table are summed up in blocks of this many starts.
_SLOTS = 1024


def _bounds() -> dict[str, Column]:
    return {"window_start": F.col("window.start"), "window_end": F.col("window.end")}


def _totals(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


TUMBLING_SUMS = (
    "total_events", "purchase_count", "page_views", "clicks", "searches",
    "revenue_parts", "order_parts", "orders",
)


def tumbling_metrics(
    events: DataFrame,
    width: str = WindowConfig.short,
    delay: str | None = None,
    distinct_error: float | None = None,
) -> DataFrame:
    """Traffic, users, sessions and revenue per window.

    Every event becomes two rows, one under its user and one under its session. The user
    rows also carry the counts and amounts, so one shuffle yields both exact distinct counts
    and all sums.

    ``distinct_error`` asks for estimated users and sessions with that relative deviation
    instead; then only one small sketch per task and window is shuffled.
    """
    stream = with_delay(events, delay)
    window = F.window("event_ts", width).alias("window")
    if distinct_error is not None:
        per_window = stream.groupBy(window).agg(
            F.approx_count_distinct("user_id", distinct_error).alias("unique_users"),
            F.approx_count_distinct("session_id", distinct_error).alias("unique_sessions"),
            *_tumbling_sums(F.lit(True)),
        )
    else:
        by_user, known = F.col("by_user"), F.col("member").isNotNull()
        per_window = (
            stream.withColumn("by_user", F.explode(F.array(F.lit(True), F.lit(False))))
            .withColumn("member", F.when(by_user, F.col("user_id")).otherwise(F.col("session_id")))
            .groupBy(window, "by_user", "member")
            .agg(*_tumbling_sums(by_user))
            .groupBy("window")
            .agg(
                F.count_if(by_user & known).alias("unique_users"),
                F.count_if(~by_user & known).alias("unique_sessions"),
                *_totals(*TUMBLING_SUMS),
            )
        )
    return per_window.withColumns(
        {
            **_bounds(),
            "total_revenue": money(F.coalesce(whole_cents("revenue_parts"), F.lit(0).cast("long"))),
            "avg_order_value": mean_money("order_parts", "orders"),
        }
    ).select(*TUMBLING_COLUMNS)


def _tumbling_sums(counted: Column) -> list[Column]:
    """The measures in ``TUMBLING_SUMS`` over the rows for which ``counted`` holds."""

    def of_type(event_type: str) -> Column:
        return F.count_if(counted & (F.col("event_type") == event_type))

    order_amount = F.when(counted & (F.col("event_type") == "purchase"), F.col("amount"))
    return [
        F.count_if(counted).alias("total_events"),
        of_type("purchase").alias("purchase_count"),
        of_type("page_view").alias("page_views"),
        of_type("click").alias("clicks"),
        of_type("search").alias("searches"),
        sum_of_parts(F.when(counted, F.col("amount"))).alias("revenue_parts"),
        sum_of_parts(order_amount).alias("order_parts"),
        F.count(finite(order_amount)).alias("orders"),
    ]


def sliding_metrics(
    events: DataFrame,
    width: str = WindowConfig.long,
    slide: str = WindowConfig.slide,
    delay: str | None = None,
) -> DataFrame:
    """Traffic, active users and revenue per sliding window.

    Where the width is a multiple of the slide, events are cut into panes one slide long and none is copied into the windows that
    cover it, however many those are: a stream copies what a user has in a pane, a table not even that. Other widths use Spark's
    sliding window as it is.
    """
    panes = micros(width) // micros(slide)
    if micros(width) != panes * micros(slide):
        metrics = _sliding_direct(with_delay(events, delay), width, slide)
    elif events.isStreaming:
        metrics = _sliding_by_panes(with_delay(events, delay), width, slide)
    else:
        metrics = _sliding_by_changes(events, slide, panes)
    return metrics.withColumn("revenue", money(whole_cents("revenue_parts"))).select(*SLIDING_COLUMNS)


def _sliding_sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("event_count"),
        revenue_parts().alias("revenue_parts"),
        *(count_of(kind).alias(count_name(kind)) for kind in SLIDING_COUNT_TYPES),
    ]


def _sliding_totals() -> list[Column]:
    return _totals("event_count", "revenue_parts", *map(count_name, SLIDING_COUNT_TYPES))


def _sliding_direct(events: DataFrame, width: str, slide: str) -> DataFrame:
    per_user = events.groupBy(F.window("event_ts", width, slide).alias("window"), "user_id").agg(
        *_sliding_sums()
    )
    return _per_window(per_user)


def _sliding_by_panes(events: DataFrame, width: str, slide: str) -> DataFrame:
    """Sliding windows of a stream by chained aggregations: what is copied into the windows that cover it is the row of a pane and a bucket of users.

    A pane is one slide long. It closes when the watermark passes its end, so an event counts if it comes before that, in
    all of its windows; one that comes later counts in none (``corrections`` computes those windows again). Users are counted exactly, in
    ``USER_BUCKETS`` buckets by hash, so that no task holds all users of a busy window.
    """
    # A pane's users travel and are kept as sets of a bucket, not as a row with sums for each user and window.
    bucket = F.pmod(F.xxhash64("user_id"), F.lit(USER_BUCKETS)).cast("int").alias("bucket")
    of_panes = events.groupBy(F.window("event_ts", slide).alias("pane"), bucket).agg(F.collect_set("user_id").alias("users"), *_sliding_sums())
    of_windows = of_panes.groupBy(F.window("pane", width, slide).alias("window"), "bucket").agg(
        F.collect_list("users").alias("users"), *_sliding_totals()
    )
    return (
        of_windows.groupBy("window")
        .agg(F.sum(F.size(F.array_distinct(F.flatten("users")))).alias("active_users"), *_sliding_totals())
        .withColumns(_bounds())
    )


def _per_window(per_user: DataFrame) -> DataFrame:
    return (
        per_user.groupBy("window")
        .agg(F.count("user_id").alias("active_users"), *_sliding_totals())
        .withColumns(_bounds())
    )


def _sliding_by_changes(events: DataFrame, slide: str, panes: int) -> DataFrame:
    """Sums and distinct users of all windows of ``panes`` consecutive panes, from what changes between windows.

    A pane enters the window that ends with it and leaves the one that starts after it: two rows for each pane, plus and
    minus its sums. A user counts from the first window that holds one of their panes up to the last, so their
    next pane only adds the windows that it newly covers: two rows for each user and pane, whatever the width. What changes is added
    up per window start, then along the starts, in blocks, so that no task orders all of them.
    """
    step = micros(slide)
    dated = events.filter(F.col("event_ts").isNotNull())
    pane = floor_div(F.unix_micros("event_ts"), step).alias("pane")
    names = ["event_count", "revenue_parts", *map(count_name, SLIDING_COUNT_TYPES)]
    measures = [*names, "active_users"]

    def changes(rows: DataFrame, first: Column, values: dict[str, Column]) -> DataFrame:
        """Rows ``slot`` and measures: ``values`` from slot ``first`` on, taken back behind slot ``pane``."""
        plus = F.struct(first.alias("slot"), *(value.alias(name) for name, value in values.items()))
        minus = F.struct((F.col("pane") + 1).alias("slot"), *((-value).alias(name) for name, value in values.items()))
        return rows.select(F.inline(F.array(plus, minus)))

    zero = F.lit(0).cast("long")
    sums = dated.groupBy(pane).agg(*_sliding_sums()).withColumn("revenue_parts", F.col("revenue_parts").cast("decimal(38,0)"))
    of_panes = changes(sums, F.col("pane") - (panes - 1), {**{name: F.col(name) for name in names}, "active_users": zero})
    # Where a block of starts begins inside a window, the running sums need a row of their own.
    edges = sums.select(
        F.explode(
            F.sequence(floor_div(F.col("pane") - (panes - 1), _SLOTS) + 1, floor_div(F.col("pane"), _SLOTS) + 1)
        ).alias("block"), "pane",
    ).filter(F.col("block") * _SLOTS <= F.col("pane") + 1)
    of_edges = edges.select(
        (F.col("block") * _SLOTS).alias("slot"),
        *(F.lit(0).cast(of_panes.schema[name].dataType).alias(name) for name in measures),
    ).distinct()

    own = W.partitionBy("user_id").orderBy("pane")
    users = (
        dated.filter(F.col("user_id").isNotNull()).select("user_id", pane).distinct()
        .withColumn("before", F.lag("pane").over(own))
    )
    fresh = F.greatest(F.col("pane") - (panes - 1), F.col("before") + 1)
    none = {name: F.lit(0).cast(of_panes.schema[name].dataType) for name in names}
    of_users = changes(users, fresh, {**none, "active_users": F.lit(1).cast("long")})

    per_slot = (
        of_panes.unionByName(of_edges).unionByName(of_users)
        .groupBy("slot").agg(*_totals(*measures))
        .withColumn("block", floor_div(F.col("slot"), _SLOTS))
    )
    # One row for each block: few, whatever the number of events.
    earlier = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = per_slot.groupBy("block").agg(*_totals(*measures)).select(
        "block", *(F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{name}_before") for name in measures)
    )
    along = W.partitionBy("block").orderBy("slot")
    running = along.rowsBetween(W.unboundedPreceding, 0)
    levels = per_slot.join(carried, "block").select(
        "slot", *((F.sum(name).over(running) + F.col(f"{name}_before")).alias(name) for name in measures),
        F.coalesce(F.lead("slot").over(along), (F.col("block") + 1) * _SLOTS).alias("next"),
    )
    return (
        levels.filter(F.col("event_count") > 0)
        .withColumn("slot", F.explode(F.sequence("slot", F.col("next") - 1)))
        .withColumn("window_start", F.timestamp_micros(F.col("slot") * step))
        .withColumn("window_end", F.timestamp_micros((F.col("slot") + panes) * step))
    )


def traffic(
    events: DataFrame, width: str = WindowConfig.short, keys: tuple[str, ...] = (), delay: str | None = None
) -> DataFrame:
    """Events, revenue and active users per window and key: what the detector takes as input."""
    per_user = (
        with_delay(events, delay)
        .groupBy(F.window("event_ts", width).alias("window"), *keys, "user_id")
        .agg(F.count(F.lit(1)).alias("event_count"), revenue_parts().alias("revenue_parts"))
    )
    return (
        per_user.groupBy("window", *keys)
        .agg(*_totals("event_count", "revenue_parts"), F.count("user_id").alias("active_users"))
        .select(
            F.col("window.start").alias("window_start"), *keys,
            "event_count", money(whole_cents("revenue_parts")).alias("revenue"), "active_users",
        )
    )


def page_counts(
    events: DataFrame, width: str = WindowConfig.short, delay: str | None = None
) -> DataFrame:
    """Page views per page and window, all pages."""
    views = events.filter(F.col("event_type") == "page_view")
    return (
        with_delay(views, delay)
        .groupBy(F.window("event_ts", width).alias("window"), "page")
        .agg(F.count(F.lit(1)).alias("view_count"))
        .withColumns(_bounds())
        .select(*PAGE_COLUMNS)
    )


def rank_pages(counts: DataFrame, n: int = WindowConfig.top_n) -> DataFrame:
    """The ``n`` most viewed pages of every window, ties by page name.

    Spark applies the limit per task before the shuffle too, so at most ``n`` rows per task
    and window travel.
    """
    order = W.partitionBy("window_start").orderBy(F.desc("view_count"), F.asc("page"))
    return (
        counts.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= n)
        .select(*PAGE_COLUMNS)
    )


def top_pages(
    events: DataFrame, n: int = WindowConfig.top_n, width: str = WindowConfig.short
) -> DataFrame:
    """The most viewed pages per window of a table.

    On a stream ranking needs whole windows: append ``page_counts`` to a table, which gets all pages of a
    window at once, and rank when it is read (``rank_pages``).
    """
    return rank_pages(page_counts(events, width), n)


def device_breakdown(
    events: DataFrame, width: str = WindowConfig.short, delay: str | None = None
) -> DataFrame:
    """Events and unique users per device and window."""
    per_user = (
        with_delay(events, delay)
        .groupBy(F.window("event_ts", width).alias("window"), "device", "user_id")
        .agg(F.count(F.lit(1)).alias("event_count"))
    )
    return (
        per_user.groupBy("window", "device")
        .agg(*_totals("event_count"), F.count("user_id").alias("unique_users"))
        .withColumns(_bounds())
        .select(*DEVICE_COLUMNS)
    )


def revenue(
    events: DataFrame, width: str = WindowConfig.short, delay: str | None = None
) -> DataFrame:
    """Sum, number, mean and maximum of the purchases per window."""
    paid = events.filter((F.col("event_type") == "purchase") & finite("amount").isNotNull())
    return (
        with_delay(paid, delay)
        .groupBy(F.window("event_ts", width).alias("window"))
        .agg(
            sum_of_parts("amount").alias("total_parts"),
            F.count(F.lit(1)).alias("order_count"),
            F.max(parts("amount")).cast("decimal(20,0)").alias("max_parts"),
        )
        .withColumns(
            {
                **_bounds(),
                "revenue": money(whole_cents("total_parts")),
                "avg_order": mean_money("total_parts", "order_count"),
                "max_order": money(whole_cents("max_parts")),
            }
        )
        .select(*REVENUE_COLUMNS)
    )


#: Columns of a stored row that can be rolled up: sums, and sketches of who was there.
SKETCHES = {"unique_users": "user_id", "unique_sessions": "session_id"}
#: Bits of a sketch's registers: 4,096 of them estimate to about 1.6 % (one standard deviation).
SKETCH_BITS = 12


def sketched_metrics(
    events: DataFrame, width: str = WindowConfig.short, keys: tuple[str, ...] = (), delay: str | None = None, bits: int = SKETCH_BITS
) -> DataFrame:
    """Sums and distinct-count sketches per window and key, to be stored and rolled up later; one shuffle of combined rows, on tables and streams."""
    stream = with_delay(events, delay)
    sums = [F.count(F.lit(1)).alias("total_events"), F.count_if(F.col("event_type") == "purchase").alias("purchase_count")]
    sketches = [F.hll_sketch_agg(F.col(member), F.lit(bits)).alias(f"{name}_sketch") for name, member in SKETCHES.items()]
    return (
        stream.groupBy(F.window("event_ts", width).alias("window"), *keys)
        .agg(*sums, sum_of_parts("amount").cast("decimal(38,0)").alias("revenue_parts"), *sketches)
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys,
                "total_events", "purchase_count", "revenue_parts", *(f"{name}_sketch" for name in SKETCHES))
    )


def roll_up(rows: DataFrame, width: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Metrics of longer windows, or of fewer keys, from ``sketched_metrics`` of windows that divide them.

    The events are not read again. Sums are exact; users and sessions are estimates of the merged sketches, as good
    as sketches of all events of the longer window would be, since merging loses nothing.
    """
    # Grouped by the row's own window start: a row lies in one longer window as a whole.
    merged = rows.groupBy(F.window("window_start", width).alias("window"), *keys).agg(
        F.sum("total_events").alias("total_events"), F.sum("purchase_count").alias("purchase_count"),
        F.sum("revenue_parts").alias("revenue_parts"),
        *(F.hll_sketch_estimate(F.hll_union_agg(f"{name}_sketch")).alias(name) for name in SKETCHES),
    )
    return merged.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "total_events", "purchase_count",
        money(F.coalesce(whole_cents("revenue_parts"), F.lit(0).cast("long"))).alias("total_revenue"), *SKETCHES,
    )

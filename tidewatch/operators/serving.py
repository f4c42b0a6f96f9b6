"""Queries behind a live view of the metric and alert tables.

Row limits here are the point of the query. Each plans as a top-k per task plus one merge of
at most ``n`` rows per task, never as a full sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.measures import ratio_sql
from tidewatch.schema import TOTALS_SCHEMA
from tidewatch.sources.tables import TOTALS, read_index


def latest(table: DataFrame, n: int = 100, time: str = "window_start") -> DataFrame:
    """The ``n`` newest rows, newest first; ties by the remaining columns."""
    ties = [F.asc(name) for name in table.columns if name != time]
    return table.orderBy(F.desc(time), *ties).limit(n)


def newest(table: DataFrame, n: int = 100, time: str = "window_start") -> DataFrame:
    """The ``n`` newest rows of a stored, date-partitioned table, reading only as many of the newest dates as hold them.

    The rows of each date are counted from the files' footers, one number a day; a constant bound on the partition column
    then keeps the reader from opening older dates. Exact for any ``n``.
    """
    per_date = table.filter(F.col("event_date").isNotNull()).groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"))
    since, held = None, 0
    for row in per_date.orderBy(F.desc("event_date")).collect():
        since, held = row.event_date, held + row.rows
        if held >= n:
            break
    bound = F.lit(True) if since is None else F.col("event_date") >= F.lit(since)
    return latest(table.filter(bound), n, time)


def history(metrics: DataFrame, n: int = 60) -> DataFrame:
    """The ``n`` newest metric rows in time order."""
    return latest(metrics, n).orderBy("window_start")


def search_alerts(
    alerts: DataFrame,
    severity: str | None = None,
    alert_type: str | None = None,
    n: int = 20,
    newest: str = "indexed_at",
) -> DataFrame:
    """The ``n`` newest alerts that fit the given severity and type, newest first; those taken back don't count."""
    if "withdrawn" in alerts.columns:
        alerts = alerts.filter(~F.col("withdrawn"))
    if severity:
        alerts = alerts.filter(F.col("severity") == severity)
    if alert_type:
        alerts = alerts.filter(F.col("alert_type") == alert_type)
    return alerts.orderBy(F.desc(newest), F.asc("alert_id")).limit(n)


def alert_dates(
    totals: DataFrame, severity: str | None = None, alert_type: str | None = None, n: int = 20
) -> list:
    """The dates that can hold the ``n`` newest alerts of a kind, from the totals beside the index; one row a date is looked at.

    Dates are added, those first whose oldest alert is the newest, until they hold ``n`` alerts. No alert indexed before the
    oldest of these is wanted, so a date whose newest one is older can be left out, however rare the kind is.
    """
    for name, value in (("severity", severity), ("alert_type", alert_type)):
        if value:
            totals = totals.filter(F.col(name) == value)
    per_date = (
        totals.filter("alerts > 0").groupBy("event_date")
        .agg(F.sum("alerts").alias("alerts"), F.min("oldest").alias("oldest"), F.max("newest").alias("newest"))
        .collect()
    )
    held, bound = 0, None
    for row in sorted(per_date, key=lambda row: row.oldest, reverse=True):
        held, bound = held + row.alerts, row.oldest
        if held >= n:
            break
    return sorted(row.event_date for row in per_date if row.newest >= bound)


def search_index(
    spark: SparkSession, path: str, severity: str | None = None, alert_type: str | None = None, n: int = 20, fmt: str = "parquet"
) -> DataFrame:
    """The ``n`` newest alerts of a stored index that fit, newest first, reading only the dates that can hold them.

    None where no alert was ever indexed.
    """
    dates = alert_dates(read_index(spark, path + TOTALS, TOTALS_SCHEMA, fmt), severity, alert_type, n)
    alerts = read_index(spark, path, fmt=fmt).filter(F.col("event_date").isin(dates) if dates else F.lit(False))
    return search_alerts(alerts, severity, alert_type, n)


def recent_alerts(
    alerts: DataFrame, shown: int = 5, loaded: int = 10, newest: str = "indexed_at"
) -> DataFrame:
    """The alerts of the status panel: severity, message and time to the second."""
    picked = search_alerts(alerts, n=loaded, newest=newest)
    return (
        picked.orderBy(F.desc(newest), F.asc("alert_id"))
        .limit(shown)
        .select(
            "alert_id", "severity", "message",
            F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("time"),
        )
    )


# Cards of the status row, their metric and whether they show a change.
KPIS = (
    ("Events / Min", "total_events", True),
    ("Active Users", "unique_users", True),
    ("Revenue / Min", "total_revenue", False),
    ("Purchases", "purchase_count", True),
    ("Avg Order", "avg_order_value", False),
)


def kpis(metrics: DataFrame) -> DataFrame:
    """The newest window against the one before it, one row per card.

    The change is in percent of the earlier value plus one, so an empty window before is no
    special case. A single window is compared with itself.
    """
    columns = [metric for _, metric, _ in KPIS]
    last_two = latest(metrics.select("window_start", *columns), 2)
    picked = last_two.agg(
        *(F.max_by(c, "window_start").alias(c) for c in columns),
        *(F.min_by(c, "window_start").alias(f"before_{c}") for c in columns),
    )

    def card(place: int, label: str, metric: str, compared: bool) -> Column:
        before = f"before_{metric}"
        change = ratio_sql(f"({metric} - {before}) * 100", f"({before} + 1)", 1) if compared else "double(null)"
        return F.struct(
            F.lit(place).alias("place"), F.lit(label).alias("kpi"),
            F.expr(f"coalesce(double({metric}), 0D)").alias("value"), F.expr(change).alias("delta_pct"),
        )

    cards = (card(place, *kpi) for place, kpi in enumerate(KPIS, 1))
    return picked.select(F.inline(F.array(*cards)))


# Labels of the event-type chart.
BREAKDOWN = (("Page Views", "page_views"), ("Clicks", "clicks"), ("Searches", "searches"))


def type_breakdown(metrics: DataFrame) -> DataFrame:
    """Total page views, clicks and searches as three rows."""
    totals = metrics.agg(
        *(F.coalesce(F.sum(metric), F.lit(0).cast("long")).alias(metric) for _, metric in BREAKDOWN)
    )
    return totals.select(
        F.inline(
            F.array(
                *(F.struct(F.lit(label).alias("type"), F.col(metric).alias("count")) for label, metric in BREAKDOWN)
            )
        )
    )


def page_share(pages: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most viewed pages with a bar length of 0 to 100 against the largest."""
    views = pages.groupBy("page").agg(F.sum("view_count").alias("view_count"))
    top = views.orderBy(F.desc("view_count"), F.asc("page")).limit(n)
    # At most n rows are left, so this window is small whatever the table holds.
    most = F.max("view_count").over(W.partitionBy(F.lit(1)))
    share = F.call_function("div", F.col("view_count") * 100, most + 1)
    return top.select("page", "view_count", F.least(share, F.lit(100).cast("long")).alias("bar_pct"))

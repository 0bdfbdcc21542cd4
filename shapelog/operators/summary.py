"""Aggregates over events: counts, top lists, histograms, per-source reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shapelog.functions.scalars import confidence_bucket

TOP_SHARES = 6
TOP_BARS = 8
SAMPLE_ROWS = 25
BUCKETS = ["high", "medium", "low"]


def or_unknown(column: str) -> Column:
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit("unknown"))


def count_by(events: DataFrame, column: str) -> DataFrame:
    return events.groupBy(or_unknown(column).alias(column)).agg(F.count("*").alias("events"))


def top(events: DataFrame, column: str, n: int = TOP_BARS) -> DataFrame:
    """The n most frequent filled values; ties by what comes first in the sources."""
    rows = events.filter(F.coalesce(F.col(column), F.lit("")) != "")
    counted = rows.groupBy(column).agg(F.count("*").alias("events"), F.min(F.struct("lineage.source_path", "lineage.line_number")).alias("first"))
    return counted.orderBy(F.desc("events"), "first").limit(n).drop("first")


def shares(events: DataFrame, column: str, n: int = TOP_SHARES) -> DataFrame:
    """The n most frequent values with their share of those n, and of all events."""
    counted = events.groupBy(or_unknown(column).alias(column)).agg(F.count("*").alias("events"), F.min(F.struct("lineage.source_path", "lineage.line_number")).alias("first"))
    total = counted.agg(F.sum("events")).scalar()
    shown = F.sum("events").over(Window.partitionBy())  # over n rows
    return counted.orderBy(F.desc("events"), "first").limit(n).select(column, "events", (100 * F.col("events") / shown).alias("pct_of_shown"), (100 * F.col("events") / total).alias("pct_of_all"))


def confidence_histogram(events: DataFrame) -> DataFrame:
    return events.groupBy(confidence_bucket(F.coalesce("confidence", F.lit(0.0))).alias("bucket")).agg(F.count("*").alias("events"))


def bucket_shares(events: DataFrame) -> DataFrame:
    """Events and percentage of each confidence bucket, none left out: three rows."""
    bucket = confidence_bucket(F.coalesce("confidence", F.lit(0.0)))
    every = events.agg(F.count("*").alias("all"), *(F.count_if(bucket == b).alias(b) for b in BUCKETS))
    rows = every.select("all", F.inline(F.array(*(F.struct(F.lit(b).alias("bucket"), F.col(b).alias("events")) for b in BUCKETS))))
    return rows.select("bucket", "events", F.round(100 * F.col("events") / F.greatest(F.col("all"), F.lit(1)), 1).alias("pct"))


def by_year(events: DataFrame) -> DataFrame:
    year = F.substring("timestamp", 1, 4)
    return events.filter(year.rlike(r"^\d{4}$")).groupBy(year.alias("year")).agg(F.count("*").alias("events")).orderBy("year")


def totals(events: DataFrame) -> DataFrame:
    """One row: events, denied, deny_rate, avg_confidence, and how many sources of each kind."""
    denied = F.count_if(F.col("action") == "deny")
    return events.agg(
        F.count("*").alias("events"), denied.alias("denied"),
        F.coalesce(100.0 * denied / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("deny_rate"),
        F.coalesce(F.avg(F.coalesce("confidence", F.lit(0.0))), F.lit(0.0)).alias("avg_confidence"),
        F.countDistinct(F.nullif(F.col("src_ip"), F.lit(""))).alias("src_ips"), F.countDistinct(or_unknown("vendor")).alias("vendors"), F.countDistinct(or_unknown("source_format")).alias("formats"),
        F.countDistinct(F.when(F.substring("timestamp", 1, 4).rlike(r"^\d{4}$"), F.substring("timestamp", 1, 4))).alias("years"),
    )


def counters(events: DataFrame) -> DataFrame:
    """All of the dashboard's counters by one scan: (counter, value, events)."""
    names = ["action", "source_format", "vendor", "src_ip", "bucket", "year"]
    rows = events.select(
        *(or_unknown(n).alias(n) for n in names[:3]), F.nullif(F.col("src_ip"), F.lit("")).alias("src_ip"), confidence_bucket(F.coalesce("confidence", F.lit(0.0))).alias("bucket"),
        F.when(F.substring("timestamp", 1, 4).rlike(r"^\d{4}$"), F.substring("timestamp", 1, 4)).alias("year"),
    )
    grouped = rows.groupingSets([[F.col(n)] for n in names], *[F.col(n) for n in names]).agg(F.grouping_id().alias("g"), F.count("*").alias("events"))
    counter = F
    for i, n in enumerate(names):
        counter = counter.when(F.col("g") == (1 << len(names)) - 1 - (1 << (len(names) - 1 - i)), n)
    out = grouped.select(counter.otherwise(None).alias("counter"), F.coalesce(*names).alias("value"), "events")
    return out.filter("value IS NOT NULL")


def sample(events: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    return events.orderBy("lineage.source_path", "lineage.line_number").limit(n)


def per_source(events: DataFrame) -> DataFrame:
    """A row per file: events, average confidence, buckets, and the first event's id."""
    bucket = confidence_bucket(F.coalesce("confidence", F.lit(0.0)))
    # Hundredths add up exactly, in any order.
    hundredths = F.sum(F.round(F.coalesce("confidence", F.lit(0.0)) * 100).cast("bigint"))
    return events.groupBy("lineage.source_path").agg(
        F.min("lineage.source_name").alias("source_name"), F.count("*").alias("events"), F.round(hundredths / (100 * F.count("*")), 2).alias("avg_confidence"),
        *(F.count_if(bucket == b).alias(b) for b in ("high", "medium", "low")), F.min_by("event_id", "lineage.line_number").alias("first_event_id"),
    )


def search(events: DataFrame, text: str) -> DataFrame:
    """Events that show a text, in any case, in one of the dashboard's columns."""
    shown = F.concat_ws(" ", "timestamp", "vendor", "source_format", "action", "src_ip", "dst_ip", F.col("confidence").cast("string"))
    return events.filter(F.lower(shown).contains(text.lower()))

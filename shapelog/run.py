"""Whole runs over log files: events to all sinks, with what is learned kept for the next run; and onboarding of one sample."""

from __future__ import annotations

import time
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelog.codebooks import load_codebooks
from shapelog.operators import onboard as sources
from shapelog.operators import summary, templates
from shapelog.operators.events import assembled, parts
from shapelog.operators.formats import file_formats, with_format
from shapelog.sources import sinks
from shapelog.sources.lines import read_lines
from shapelog.sources.shared import keep, latest


def process(spark: SparkSession, paths: list[str], out: str, state: str, now: Column | None = None, books: list[dict] | None = None, min_occurrences: int = templates.MIN_OCCURRENCES) -> dict:
    """Read files, write all sinks under `out`, and keep templates, codebook and registry under `state`.

    Templates go on from those of the run before. Lines go by the codebook that earlier runs learned; what
    this run's templates add to it counts from the next run on. Both folders are shared ones. Returns the
    events (as read back), the promoted entries, the registry, and the seconds that the run took.
    """
    began = time.time()
    lines = read_lines(spark, *paths)
    formats = file_formats(lines).persist()
    parsed, rest = parts(with_format(lines, formats), books)
    mined = keep(templates.train(rest, known=latest(spark, f"{state}/templates")), f"{state}/templates")
    codebook = latest(spark, f"{state}/codebook")
    sinks.write_all(assembled(parsed, templates.match(rest, mined, codebook), now), out)
    promoted = templates.promote(mined, min_occurrences, codebook)
    learned = keep(promoted if codebook is None else codebook.unionByName(promoted), f"{state}/codebook")
    promoted = learned if codebook is None else learned.join(codebook.select("signature"), "signature", "left_anti")
    stamp = time.strftime("%Y-%m-%dT%H:%M:%S+00:00", time.gmtime())
    registry = keep(sources.register(formats.select("source_name", "source_path", "format"), stamp, latest(spark, f"{state}/registry")), f"{state}/registry")
    found = sinks.unflatten(spark.read.parquet(f"{out}/events.parquet"))
    return {"events": found, "promoted": promoted, "registry": registry, "seconds": time.time() - began}


def report(events: DataFrame, promoted: DataFrame | None = None, seconds: float | None = None) -> DataFrame:
    """A run's report as numbered lines of text: files, confidence, totals, promoted templates, throughput."""
    files = summary.per_source(events).orderBy("source_path").select(F.lit(1).alias("part"), "source_path", F.format_string("%-32s %8d events  average confidence %.2f  high %d, medium %d, low %d", "source_name", "events", "avg_confidence", "high", "medium", "low").alias("line"))
    buckets = summary.bucket_shares(events).select(F.lit(2).alias("part"), F.col("bucket").alias("source_path"), F.format_string("%-6s confidence: %d events, %.1f%%", "bucket", "events", "pct").alias("line"))
    per_second = F.lit("") if seconds is None else F.format_string(", %.0f events a second", F.col("events") / max(seconds, 1e-9))
    whole = summary.totals(events).select(F.lit(3).alias("part"), F.lit("").alias("source_path"), F.concat(F.format_string("%d events, %d denied (%.1f%%), %d source addresses, %d formats, %d vendors", "events", "denied", "deny_rate", "src_ips", "formats", "vendors"), per_second).alias("line"))
    every = files.unionByName(buckets).unionByName(whole)
    if promoted is not None:
        every = every.unionByName(templates.review_summary(promoted).select(F.lit(4).alias("part"), F.col("line").alias("source_path"), "line"))
    return every.orderBy("part", "source_path").select("line")


def onboard(spark: SparkSession, sample: str, name: str, state: str, folder: str = ".", books: list[dict] | None = None) -> dict:
    """Take up one sample as a source: told by its format, registered, and with a codebook to fill in where it needs one.

    The codebook is written to `folder` on the driver. Returns what the report says of the sample, and the path.
    """
    lines = read_lines(spark, sample).withColumn("source_name", F.lit(name))
    found = sources.onboarding_report(lines, books or load_codebooks()).first()
    result = found.asDict() if found else {"source_path": sample, "source_name": name, "format": "unknown", "status": sources.STATUS_FALLBACK, "lines": 0, "prefix": None, "needs": "review of templates"}
    if result["needs"] == "codebook":
        result["codebook"] = str(Path(folder) / f"{result['prefix'].lower()}.json")
        result["codes"] = sources.scaffold_codebook(lines, result["prefix"], result["codebook"])
    stamp = time.strftime("%Y-%m-%dT%H:%M:%S+00:00", time.gmtime())
    seen = spark.createDataFrame([(name, result["source_path"], result["format"])], "source_name string, source_path string, format string")
    keep(sources.register(seen, stamp, latest(spark, f"{state}/registry")), f"{state}/registry")
    return result

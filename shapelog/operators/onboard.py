"""Sources: what is known of each, what a new one needs, and a registry of those seen."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelog.codebooks import load_codebooks
from shapelog.functions.sniff import CODED
from shapelog.functions.text import strip
from shapelog.operators.formats import file_formats
from shapelog.schema import SELF_DESCRIBING, STATUS_AUTO, STATUS_CODEBOOK, STATUS_FALLBACK

REGISTRY = "source_name string, first_seen string, last_seen string, detected_format string, onboarding_status string, files_processed bigint, last_file string"


def onboarding_status(form: Column) -> Column:
    return F.when(form.isin(SELF_DESCRIBING), STATUS_AUTO).when(form == "coded_syslog", STATUS_CODEBOOK).otherwise(STATUS_FALLBACK)


def onboarding_report(lines: DataFrame, books: list[dict] | None = None) -> DataFrame:
    """A row per file: its format, status, lines, the first message prefix and whether a codebook covers it."""
    covered = [b.get("prefix", b["vendor"].upper()) for b in (books or load_codebooks())]
    prefix = F.regexp_extract("raw", r"%([A-Za-z0-9_]+)-\d-\d+:", 1)
    seen = lines.groupBy("source_path").agg(F.count("*").alias("lines"), F.min_by(F.when(F.col("raw").rlike(CODED), prefix), F.when(F.col("raw").rlike(CODED), F.col("line_number"))).alias("prefix"))
    rows = file_formats(lines).select("source_path", "source_name", "format").join(seen, "source_path")
    coded = F.col("format") == "coded_syslog"
    needs = F.when(coded & ~F.coalesce(F.col("prefix").isin(covered), F.lit(False)), "codebook").when(F.col("format") == "unknown", "review of templates").otherwise("nothing")
    return rows.select("source_path", "source_name", "format", onboarding_status(F.col("format")).alias("status"), "lines", F.when(coded, F.col("prefix")).alias("prefix"), needs.alias("needs"))


def scaffold_codes(lines: DataFrame, prefix: str) -> DataFrame:
    """(code, seen_count, example_line) of a prefix's messages, the most frequent first."""
    code = F.regexp_extract("raw", rf"%{re.escape(prefix)}-\d-(\d+):", 1)
    rows = lines.withColumn("code", code).filter("code <> ''")
    return rows.groupBy("code").agg(F.count("*").alias("seen_count"), F.min_by(strip(F.col("raw")), F.struct("source_path", "line_number")).alias("example_line")).orderBy(F.desc("seen_count"), "code")


def scaffold_codebook(lines: DataFrame, prefix: str, path: str) -> int:
    """Write a codebook to be filled in; a prefix has at most a few thousand codes."""
    todo = {"description": "TODO: describe this message", "action": "other", "event_type": "other", "regex": "TODO: a pattern with named groups, e.g. (?P<src_ip>[\\d.]+)"}
    messages = [{"code": r.code} | todo | {"_example_line": r.example_line, "_seen_count": r.seen_count} for r in scaffold_codes(lines, prefix).collect()]
    Path(path).write_text(json.dumps({"vendor": prefix.lower(), "prefix": prefix, "product": "TODO: fill in", "messages": messages}, indent=2), encoding="utf-8")
    return len(messages)


def register(seen: DataFrame, now: str, registry: DataFrame | None = None) -> DataFrame:
    """The registry after files were seen: (source_name, source_path, format) rows, in the order of their paths."""
    last = F.struct("source_path", "format")
    new = seen.groupBy("source_name").agg(F.count("*").alias("files"), F.max(last).alias("last"))
    old = registry if registry is not None else seen.sparkSession.createDataFrame([], REGISTRY)
    both = old.join(new, "source_name", "full")
    form = F.coalesce("last.format", "detected_format")
    return both.select(
        "source_name", F.coalesce("first_seen", F.lit(now)).alias("first_seen"), F.when(F.col("files").isNotNull(), F.lit(now)).otherwise(F.col("last_seen")).alias("last_seen"),
        form.alias("detected_format"), onboarding_status(form).alias("onboarding_status"), (F.coalesce("files_processed", F.lit(0)) + F.coalesce("files", F.lit(0))).cast("bigint").alias("files_processed"),
        F.coalesce("last.source_path", "last_file").alias("last_file"),
    )


def save_registry(registry: DataFrame, path: str) -> int:
    """One row per source, written by the driver alone."""
    rows = {r.source_name: r.asDict() for r in registry.orderBy("source_name").collect()}
    Path(path).write_text(json.dumps(rows, indent=2), encoding="utf-8")
    return len(rows)


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    names = [x.split()[0] for x in REGISTRY.split(", ")]
    state = json.loads(Path(path).read_text(encoding="utf-8")) if Path(path).exists() else {}
    return spark.createDataFrame([tuple(r[n] for n in names) for r in state.values()], REGISTRY)


def registry_lines(registry: DataFrame) -> DataFrame:
    """The registry as lines of text."""
    return registry.orderBy("source_name").select(F.format_string("%-28s %-14s %-45s %d", "source_name", "detected_format", "onboarding_status", "files_processed").alias("line"))

"""Functions for SQL users: temporary SQL functions, which Catalyst expands in place.

Each is written out from the column function of the same purpose, so both give the same values.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelog.functions import parse, profile, scalars, sniff, tags, timestamps

FIELDS = "MAP<STRING, STRING>"
PROFILE = "STRUCT<timestamp: STRING, severity: STRING, host: STRING, process: STRING, pid: STRING>"
TAGGED = "STRUCT<value: STRING, guessed_type: STRING, ip: STRING, port: STRING, src_ip: STRING, src_port: STRING, dst_ip: STRING, dst_port: STRING>"
TEXT = re.compile(r"'(?:[^'\\]|\\.)*'")
OPERATOR = re.compile(r"(?<![\w`])([=<>!+\-*/%]+)\(")


def as_sql(column: Column) -> str:
    """A column's expression as SQL that can be parsed: operators are called by their names in backquotes."""
    text, out, at = column._jc.node().sql(), [], 0
    for quoted in TEXT.finditer(text):
        out += [OPERATOR.sub(r"`\1`(", text[at : quoted.start()]), quoted[0]]
        at = quoted.end()
    return "".join([*out, OPERATOR.sub(r"`\1`(", text[at:])])


def definitions(books: list[dict] | None = None) -> dict[str, Column]:
    """Signature and column of each function."""
    x, now = F.col("x"), F.col("now")
    return {
        "log_action(x STRING) RETURNS STRING": scalars.normalize_action(x),
        "log_guess_action(x STRING) RETURNS STRING": scalars.guess_action(x),
        "log_protocol(x STRING) RETURNS STRING": scalars.normalize_protocol(x),
        "log_int(x STRING) RETURNS BIGINT": scalars.to_int(x),
        "log_confidence_bucket(x DOUBLE) RETURNS STRING": scalars.confidence_bucket(x),
        "log_ipv4s(x STRING) RETURNS ARRAY<STRING>": scalars.ipv4s(x),
        "log_event_id(path STRING, line BIGINT, raw STRING) RETURNS STRING": scalars.event_id(F.col("path"), F.col("line"), F.col("raw")),
        "log_sniff(x STRING) RETURNS STRING": sniff.sniff_line(x),
        "log_timestamp(x STRING, now TIMESTAMP) RETURNS STRING": timestamps.normalize_timestamp(x, now),
        "log_epoch(x STRING) RETURNS STRING": timestamps.epoch_to_iso(x),
        f"log_profile(x STRING) RETURNS {PROFILE}": profile.profile_line(x),
        f"log_tag(x STRING) RETURNS {TAGGED}": tags.tag_variable(x),
        f"log_parse_json(x STRING) RETURNS {FIELDS}": parse.parse_json(x),
        f"log_parse_kv(x STRING) RETURNS {FIELDS}": parse.parse_kv(x),
        f"log_parse_cef(x STRING) RETURNS {FIELDS}": parse.parse_cef(x),
        f"log_parse_leef(x STRING) RETURNS {FIELDS}": parse.parse_leef(x),
        f"log_parse_rfc5424(x STRING) RETURNS {FIELDS}": parse.parse_rfc5424(x),
        f"log_parse_coded(x STRING) RETURNS {FIELDS}": parse.parse_coded(x, books),
        f"log_parse_csv(header STRING, x STRING) RETURNS {FIELDS}": parse.parse_csv(F.col("header"), x),
    }


def register(spark: SparkSession, books: list[dict] | None = None) -> list[str]:
    """Create the functions in the session; returns their names."""
    found = definitions(books)
    for signature, column in found.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {as_sql(column)}")
    return [s.split("(")[0] for s in found]


def parse_log(spark: SparkSession, *paths: str, view: str = "log_events") -> DataFrame:
    """Events of log files, also as a view for SQL."""
    from shapelog.operators.events import events
    from shapelog.sources.lines import read_lines

    found = events(read_lines(spark, *paths))
    found.createOrReplaceTempView(view)
    return found

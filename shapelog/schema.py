"""The event: one fixed schema for every source format."""

from __future__ import annotations

from pyspark.sql import types as T

# The event's fields in order, and what each index type is.
EVENT_FIELDS = [
    ("event_id", "string", "keyword"),
    ("timestamp", "string", "date"),
    ("vendor", "string", "keyword"),
    ("source_format", "string", "keyword"),
    ("event_type", "string", "keyword"),
    ("action", "string", "keyword"),
    ("severity", "string", "keyword"),
    ("src_ip", "string", "ip"),
    ("src_port", "bigint", "integer"),
    ("dst_ip", "string", "ip"),
    ("dst_port", "bigint", "integer"),
    ("protocol", "string", "keyword"),
    ("bytes_sent", "bigint", "long"),
    ("bytes_received", "bigint", "long"),
    ("packets", "bigint", "long"),
    ("user", "string", "keyword"),
    ("host", "string", "keyword"),
    ("process", "string", "keyword"),
    ("pid", "string", "keyword"),
    ("message", "string", "text"),
    ("confidence", "double", "float"),
]
LINEAGE_FIELDS = [
    ("event_id", "string", "keyword"),
    ("source_path", "string", "keyword"),
    ("source_name", "string", "keyword"),
    ("line_number", "bigint", "long"),
    ("ingested_at", "string", "date"),
]

# Actions by keyword; the order is the precedence in free text.
ACTIONS = [
    ("allow", "allow"), ("accept", "allow"), ("permit", "allow"), ("built", "allow"), ("successful", "allow"), ("success", "allow"),
    ("deny", "deny"), ("reject", "deny"), ("block", "deny"), ("blocked", "deny"), ("rejected", "deny"), ("drop", "deny"), ("dropped", "deny"),
    ("login", "auth"), ("authentication", "auth"),
    ("teardown", "other"),
]
# IP protocol numbers.
PROTOCOLS = [("1", "icmp"), ("6", "tcp"), ("17", "udp")]
# The source formats, and those that describe themselves.
FORMATS = ["json", "csv", "kv_syslog", "cef", "leef", "syslog5424", "coded_syslog", "unknown"]
SELF_DESCRIBING = ["json", "csv", "kv_syslog", "cef", "leef", "syslog5424"]
# What a registry says about each kind of format.
STATUS_AUTO = "auto (zero-code, self-describing shape)"
STATUS_CODEBOOK = "codebook-driven (JSON config only)"
STATUS_FALLBACK = "fallback (statistical, needs review before trusting fully)"

_KINDS = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType()}
LINEAGE_SCHEMA = T.StructType([T.StructField(n, _KINDS[t]) for n, t, _ in LINEAGE_FIELDS])
EVENT_SCHEMA = T.StructType([*(T.StructField(n, _KINDS[t]) for n, t, _ in EVENT_FIELDS), T.StructField("lineage", LINEAGE_SCHEMA), T.StructField("raw", T.StringType())])

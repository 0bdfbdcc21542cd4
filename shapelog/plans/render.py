"""Log lines of every shape, rendered from the table `events`, and what an event must then hold.

The lines go through the real parsers; the SQL beside each query takes the expected values straight
from the table's columns and shares no code with the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CSV_HEADER = "timestamp,action,source_ip,source_port,destination_ip,destination_port,protocol,bytes_sent,bytes_received,packets"

BASE = """
    event_id, user_id, substring(cast(ts AS string), 1, 19) AS at,
    concat('10.0.', user_id div 256, '.', user_id % 256) AS src_ip, 1024 + event_id % 60000 AS src_port,
    concat('192.168.1.', 1 + event_id % 250) AS dst_ip, 1 + event_id % 1000 AS dst_port,
    CASE event_type WHEN 'view' THEN 'accept' WHEN 'signup' THEN 'login' WHEN 'purchase' THEN 'allow' WHEN 'error' THEN 'deny' ELSE 'noop' END AS word,
    CASE event_id % 3 WHEN 0 THEN '6' WHEN 1 THEN '17' ELSE '1' END AS proto,
    cast(floor(value * 100) AS bigint) AS sent, cast(floor(value) AS bigint) AS received, 1 + event_id % 7 AS packets, event_type, value, ts
"""

SQL_BASE = """
WITH e AS (
  SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') AS iso,
    '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS src_ip, 1024 + event_id % 60000 AS src_port,
    '192.168.1.' || (1 + event_id % 250) AS dst_ip, 1 + event_id % 1000 AS dst_port,
    CASE event_type WHEN 'view' THEN 'allow' WHEN 'signup' THEN 'auth' WHEN 'purchase' THEN 'allow' WHEN 'error' THEN 'deny' ELSE 'other' END AS action,
    CASE event_type WHEN 'view' THEN 'accept' WHEN 'signup' THEN 'login' WHEN 'purchase' THEN 'allow' WHEN 'error' THEN 'deny' ELSE 'noop' END AS word,
    CASE event_id % 3 WHEN 0 THEN 'tcp' WHEN 1 THEN 'udp' ELSE 'icmp' END AS protocol,
    CAST(floor(value * 100) AS BIGINT) AS sent, CAST(floor(value) AS BIGINT) AS received, 1 + event_id % 7 AS packets, event_type, value, ts
  FROM events
)"""

# Of each shape: an expression of the line.
LINES = {
    "kv_syslog": """concat('date=', split(at, ' ')[0], ' time=', split(at, ' ')[1], ' type="', event_type, '" action="', word, '" srcip=', src_ip, ' srcport=', src_port,
        ' dstip=', dst_ip, ' dstport=', dst_port, ' proto=', proto, ' sentbyte=', sent, ' rcvdbyte=', received, ' user="user ', user_id, '" msg="event ', event_id, ' seen"')""",
    "cef": """concat(at, ' fw1 CEF:0|Acme|Wall|1.2|', event_id, '|', event_type, '|5|act=', word, ' src=', src_ip, ' spt=', src_port, ' dst=', dst_ip, ' dpt=', dst_port,
        ' proto=', proto, ' out=', sent, ' in=', received, ' duser=user ', user_id, ' cat=', event_type, ' msg=event ', event_id, ' seen')""",
    "leef": """concat(at, ' fw2 LEEF:2.0|Acme|Wall|1.2|', word, '|^|devTime=', at, '^src=', src_ip, '^srcPort=', src_port, '^dst=', dst_ip, '^dstPort=', dst_port,
        '^proto=', proto, '^bytesOut=', sent, '^bytesIn=', received, '^usrName=user ', user_id, '^cat=', event_type)""",
    "syslog5424": """concat('<134>1 ', replace(at, ' ', 'T'), 'Z gw1 flowd ', user_id, ' ID7 [flow@1 srcIP="', src_ip, '" srcPort="', src_port, '" dstIP="', dst_ip, '" dstPort="', dst_port,
        '" proto="', proto, '"] [more@1 action="', word, '" bytesSent="', sent, '" bytesRecv="', received, '" user="user ', user_id, '"] event ', event_id, ' seen')""",
    "json": """concat('{"start": ', unix_seconds(cast(concat(at, 'Z') AS timestamp)), ', "action": "', word, '", "srcaddr": "', src_ip, '", "srcport": ', src_port, ', "dstaddr": "', dst_ip, '", "dstport": "', dst_port,
        '", "protocol": ', proto, ', "bytes": ', sent, ', "packets": ', packets, '}')""",
    "csv": "concat_ws(',', at, word, src_ip, src_port, dst_ip, dst_port, proto, sent, received, packets)",
}

COLUMNS = ["line_number", "timestamp", "vendor", "source_format", "event_type", "action", "src_ip", "src_port", "dst_ip", "dst_port", "protocol", "bytes_sent", "bytes_received", "packets", "user", "message", "confidence"]

# Of each shape: the columns that differ between shapes, in SQL over SQL_BASE.
EXPECTED = {
    "kv_syslog": ("'fortinet'", "event_type", "received", "NULL", "'user ' || user_id", "'event ' || event_id || ' seen'", "0.95"),
    "cef": ("'acme'", "event_type", "received", "NULL", "'user ' || user_id", "'event ' || event_id || ' seen'", "0.95"),
    "leef": ("'acme'", "event_type", "received", "NULL", "'user ' || user_id", "event_type", "0.95"),
    "syslog5424": ("'flowd'", "'traffic'", "received", "NULL", "'user ' || user_id", "'event ' || event_id || ' seen'", "0.95"),
    "json": ("'cloud'", "'flow'", "NULL", "packets", "NULL", "NULL", "0.98"),
    "csv": ("'generic'", "'traffic'", "received", "packets", "NULL", "NULL", "0.98"),
}


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as columns to render lines from; a table of a few blocks is dealt over all cores, as log files' splits are."""
    events, cores = spark.read.parquet(f"{sf_dir}/events.parquet"), spark.sparkContext.defaultParallelism
    events = events.repartition(cores) if events.rdd.getNumPartitions() < cores else events
    return events.selectExpr(*[x.strip() for x in _items(BASE)])


def _items(text: str) -> list[str]:
    """Split at commas outside brackets."""
    out, depth, now = [], 0, ""
    for c in text.strip():
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(now)
            now = ""
        else:
            now += c
    return [*out, now]


def lines(spark: SparkSession, sf_dir: str, shape: str, number: str = "event_id + 1") -> DataFrame:
    """One file of a shape, its format known."""
    return base(spark, sf_dir).select(
        F.lit(f"/logs/{shape}.log").alias("source_path"), F.lit(shape).alias("source_name"), F.expr(number).cast("bigint").alias("line_number"), F.expr(LINES[shape]).alias("raw"),
        F.lit(shape).alias("format"), F.lit(CSV_HEADER if shape == "csv" else None).cast("string").alias("header"), "event_id",
    )


def mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six files, one of each shape, with the events dealt out; the table starts with its header."""
    shapes = list(LINES)
    shape = F.expr("CASE event_id % 6 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(shapes)) + " END")
    raw = F.expr("CASE event_id % 6 " + " ".join(f"WHEN {i} THEN {LINES[s]}" for i, s in enumerate(shapes)) + " END")
    rows = base(spark, sf_dir).select(shape.alias("source_name"), F.expr("event_id div 6 + CASE WHEN event_id % 6 = 5 THEN 2 ELSE 1 END").cast("bigint").alias("line_number"), raw.alias("raw"))
    header = spark.range(1).select(F.lit("csv").alias("source_name"), F.lit(1).cast("bigint").alias("line_number"), F.lit(CSV_HEADER).alias("raw"))
    return rows.unionByName(header).select(F.concat(F.lit("/logs/"), "source_name", F.lit(".log")).alias("source_path"), "source_name", "line_number", "raw")


def event_columns(events: DataFrame) -> DataFrame:
    return events.withColumn("line_number", F.col("lineage.line_number")).select(*COLUMNS)


def expected(shape: str, number: str = "event_id + 1", where: str = "TRUE") -> str:
    vendor, kind, received, packets, user, message, confidence = EXPECTED[shape]
    return f"""SELECT CAST({number} AS BIGINT) AS line_number, iso AS "timestamp", {vendor} AS vendor, '{shape}' AS source_format, {kind} AS event_type, action, src_ip,
  CAST(src_port AS BIGINT) AS src_port, dst_ip, CAST(dst_port AS BIGINT) AS dst_port, protocol, sent AS bytes_sent, CAST({received} AS BIGINT) AS bytes_received,
  CAST({packets} AS BIGINT) AS packets, {user} AS "user", {message} AS message, CAST({confidence} AS DOUBLE) AS confidence FROM e WHERE {where}"""



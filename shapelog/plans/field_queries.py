"""Queries over lines of unknown shape field by field, and over sources, sinks, codebooks and runs; with SQL for the same rows."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelog import run
from shapelog.functions import profile, tags
from shapelog.functions import sql as sql_functions
from shapelog.operators import summary, templates
from shapelog.operators.events import events
from shapelog.plans.queries import NOW, _FIRST, _SHAPES, _TEMPLATE, SQL_MIXED, free_lines, mixed_events, query
from shapelog.plans.render import CSV_HEADER, LINES, SQL_BASE, base, lines
from shapelog.sources import sinks
from shapelog.sources.lines import read_lines
from shapelog.sources.shared import shared_folder
from shapelog.streaming.events import distinct_events, windowed_counts

#: Of each kind of line of unknown shape: the line, and what its event holds (SQL over SQL_BASE; the rest is null).
UNKNOWN = [
    ("concat('Jun 14 15:16:01 web-', user_id, ' sshd[', event_id, ']: WARNING login by user=u', user_id, ', now')",
     {"timestamp": "'2024-06-14T15:16:01.000Z'", "severity": "'warning'", "host": "'web-' || user_id", "process": "'sshd'", "pid": "'' || event_id", "user": "'u' || user_id", "action": "'auth'", "message": "'Jun 14 15:16:01 <*> <*> WARNING login by <*> now'", "confidence": "0.6"}),
    ("concat('conn ', src_ip, ':', src_port, '->', dst_ip, ':', dst_port, ' closed proto=', proto, ' bytes_received=', received)",
     {"src_ip": "src_ip", "src_port": "src_port", "dst_ip": "dst_ip", "dst_port": "dst_port", "protocol": "protocol", "bytes_received": "received", "message": "'conn <*> closed <*> <*>'", "confidence": "0.45"}),
    ("concat('proxy ', src_ip, ':', src_port, ' to ', dst_ip, ':', dst_port, ' len: ', sent, ' packets: ', packets, ' proto: TCP')",
     {"src_ip": "src_ip", "src_port": "src_port", "dst_ip": "dst_ip", "dst_port": "dst_port", "protocol": "'tcp'", "bytes_received": "sent", "packets": "packets", "message": "'proxy <*> to <*> len: <*> packets: <*> proto: TCP'", "confidence": "0.45"}),
    ("concat('rhost=', src_ip, '; dst=', dst_ip, ', was blocked at ', sent, ' rcvd=', received)",
     {"src_ip": "src_ip", "src_port": "CASE WHEN sent BETWEEN 1 AND 65535 THEN sent END", "dst_ip": "dst_ip", "bytes_received": "received", "action": "'deny'", "message": "'<*> <*> was blocked at <*> <*>'", "confidence": "0.45"}),
    ("concat('event on 2024-01-', lpad(1 + event_id % 28, 2, '0'), ' at ', lpad(event_id % 24, 2, '0'), ':', lpad(event_id % 60, 2, '0'), ':07 ended well')",
     {"timestamp": "'2024-01-' || lpad('' || (1 + event_id % 28), 2, '0') || 'T' || lpad('' || (event_id % 24), 2, '0') || ':' || lpad('' || (event_id % 60), 2, '0') || ':07.000Z'", "message": "'event on <*> at <*> ended well'", "confidence": "0.35"}),
    ("concat('06-0', 1 + event_id % 9, ' 10:11:12.345 ', 1000 + event_id % 7, ' ', 2000 + event_id % 9, ' E Tag: failed name')",
     {"timestamp": "'2024-06-0' || (1 + event_id % 9) || 'T10:11:12.345Z'", "severity": "'error'", "message": "'<*> 10:11:12.345 <*> <*> E Tag: failed name'", "confidence": "0.45"}),
    ("concat('from [', src_ip, '] via (', dst_ip, ') done with it')",
     {"src_ip": "src_ip", "dst_ip": "dst_ip", "message": "'from <*> via <*> done with it'", "confidence": "0.4"}),
    ("concat('seen ', dst_ip, ' ip=', src_ip, ' twice permit')",
     {"src_ip": "src_ip", "dst_ip": "dst_ip", "action": "'allow'", "message": "'seen <*> <*> twice permit'", "confidence": "0.4"}),
    ("concat('echo ', src_ip, ' ', src_ip, ' teardown port ', src_port)",
     {"src_ip": "src_ip", "src_port": "src_port", "message": "'echo <*> <*> teardown port <*>'", "confidence": "0.4"}),
    ("concat('node 1077804742 unit username=u', user_id, ' CRITICAL halt ', event_id)",
     {"timestamp": "'2004-02-26T14:12:22.000Z'", "severity": "'critical'", "user": "'u' || user_id", "message": "'node 1077804742 unit <*> CRITICAL halt <*>'", "confidence": "0.5"}),
]
FIELDS = {
    "timestamp": "VARCHAR", "severity": "VARCHAR", "host": "VARCHAR", "process": "VARCHAR", "pid": "VARCHAR", "user": "VARCHAR", "src_ip": "VARCHAR", "src_port": "BIGINT", "dst_ip": "VARCHAR", "dst_port": "BIGINT",
    "protocol": "VARCHAR", "bytes_received": "BIGINT", "packets": "BIGINT", "action": "VARCHAR", "message": "VARCHAR", "confidence": "DOUBLE",
}


def _unknown(field: str, kind: str) -> str:
    default = "'other'" if field == "action" else "NULL"
    cases = " ".join(f"WHEN {i} THEN CAST({want.get(field, default)} AS {kind})" for i, (_, want) in enumerate(UNKNOWN))
    return f'CASE event_id % {len(UNKNOWN)} {cases} END AS "{field}"'


SQL_UNKNOWN = f"""{SQL_BASE}, ev AS (SELECT event_id + 1 AS line_number, {', '.join(_unknown(f, k) for f, k in FIELDS.items())},
  CASE WHEN event_id % {len(UNKNOWN)} IN (1, 2, 3, 6, 7, 8) THEN 'traffic' ELSE 'unclassified' END AS event_type, 'unknown' AS vendor, 'unknown' AS source_format FROM e)"""


def unknown_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = f"CASE event_id % {len(UNKNOWN)} " + " ".join(f"WHEN {i} THEN {x}" for i, (x, _) in enumerate(UNKNOWN)) + " END"
    return base(spark, sf_dir).selectExpr("'/logs/odd.log' AS source_path", "'odd' AS source_name", "event_id + 1 AS line_number", f"{raw} AS raw", "'unknown' AS format", "CAST(NULL AS STRING) AS header")


def unknown_shape_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(unknown_lines(spark, sf_dir), F.to_timestamp(F.lit(NOW)))


@query("unknown_fields", f"{SQL_UNKNOWN} SELECT * FROM ev")
def unknown_fields(spark, sf_dir):
    """Every field of events that go by template: stamps, profile, pairs, flows, addresses, ports, and the confidence they add up to."""
    return unknown_shape_events(spark, sf_dir).withColumn("line_number", F.col("lineage.line_number")).select("line_number", *FIELDS, "event_type", "vendor", "source_format")


_BUCKET = "CASE WHEN confidence >= 0.8 THEN 'high' WHEN confidence >= 0.4 THEN 'medium' ELSE 'low' END"


@query("bucket_shares", f"{SQL_UNKNOWN} SELECT bucket, count(confidence) AS events, round(100 * count(confidence) / (SELECT count(*) FROM ev), 1) AS pct FROM (VALUES ('high'), ('medium'), ('low')) b(bucket) LEFT JOIN ev ON {_BUCKET} = bucket GROUP BY bucket")
def bucket_shares(spark, sf_dir):
    return summary.bucket_shares(unknown_shape_events(spark, sf_dir))


@query("unknown_conf_hist", f"{SQL_UNKNOWN} SELECT {_BUCKET} AS bucket, count(*) AS events FROM ev GROUP BY ALL")
def unknown_conf_hist(spark, sf_dir):
    return summary.confidence_histogram(unknown_shape_events(spark, sf_dir))


@query("unknown_years", f"{SQL_UNKNOWN} SELECT substr(\"timestamp\", 1, 4) AS year, count(*) AS events FROM ev WHERE \"timestamp\" IS NOT NULL GROUP BY ALL")
def unknown_years(spark, sf_dir):
    return summary.by_year(unknown_shape_events(spark, sf_dir))


@query("console_report", f"""{SQL_UNKNOWN}, c AS (SELECT count(*) AS n, sum(CAST(round(confidence * 100) AS BIGINT)) / count(*) / 100 AS a, count(*) FILTER ({_BUCKET} = 'high') AS h, count(*) FILTER ({_BUCKET} = 'medium') AS m, count(*) FILTER ({_BUCKET} = 'low') AS l,
  count(*) FILTER (action = 'deny') AS d, count(DISTINCT src_ip) AS s FROM ev)
SELECT printf('%-32s %8d events  average confidence %.2f  high %d, medium %d, low %d', 'odd', n, round(a, 2), h, m, l) AS line FROM c
UNION ALL SELECT printf('%-6s confidence: %d events, %.1f%%', b, k, round(100 * k / n, 1)) FROM (SELECT n, unnest(['high', 'medium', 'low']) AS b, unnest([h, m, l]) AS k FROM c)
UNION ALL SELECT printf('%d events, %d denied (%.1f%%), %d source addresses, 1 formats, 1 vendors', n, d, 100.0 * d / n, s) FROM c""")
def console_report(spark, sf_dir):
    return run.report(unknown_shape_events(spark, sf_dir))


@query("blank_lines", f"{SQL_BASE} SELECT 3 * event_id + 1 AS line_number, action FROM e")
def blank_lines(spark, sf_dir):
    """Blank lines give no event but count; two follow each line."""
    rows = lines(spark, sf_dir, "kv_syslog").withColumn("raw", F.explode(F.array("raw", F.lit("  "), F.lit("\t"))))
    place = F.when(F.col("raw") == "  ", 2).when(F.col("raw") == "\t", 3).otherwise(1)
    rows = rows.withColumn("line_number", 3 * F.col("event_id") + place).drop("event_id")
    return events(rows).select("lineage.line_number", "action")


# --- profile and tokens as a whole ----------------------------------------------------------------

@query("profile_line", f"""{SQL_BASE} SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'Jun 14 15:16:01' WHEN 1 THEN replace(e.at, ' ', 'T') || ',5' END AS "timestamp", CASE event_id % 3 WHEN 0 THEN 'warning' WHEN 1 THEN 'error' END AS severity,
  CASE event_id % 3 WHEN 0 THEN 'web-' || user_id END AS host, CASE event_id % 3 WHEN 0 THEN 'sshd' END AS process, CASE event_id % 3 WHEN 0 THEN '' || event_id END AS pid FROM e""")
def profile_whole(spark, sf_dir):
    text = "CASE event_id % 3 WHEN 0 THEN concat('Jun 14 15:16:01 web-', user_id, ' sshd[', event_id, ']: WARN x') WHEN 1 THEN concat(replace(at, ' ', 'T'), ',5 [ERR] y') ELSE 'informal' END"
    return base(spark, sf_dir).select("event_id", profile.profile_line(F.expr(text)).alias("p")).select("event_id", "p.*")


@query("compound_split", f"""{SQL_BASE} SELECT event_id, CASE event_id % 3 WHEN 0 THEN src_ip END AS ip, CASE event_id % 3 WHEN 0 THEN '' || src_port END AS port, CASE event_id % 3 WHEN 1 THEN src_ip END AS src_ip,
  CASE event_id % 3 WHEN 1 THEN '' || src_port END AS src_port, CASE event_id % 3 WHEN 1 THEN dst_ip END AS dst_ip, CASE event_id % 3 WHEN 1 THEN '' || dst_port END AS dst_port FROM e""")
def compound_split(spark, sf_dir):
    text = "CASE event_id % 3 WHEN 0 THEN concat(src_ip, ':', src_port) WHEN 1 THEN concat(src_ip, ':', src_port, '>', dst_ip, ':', dst_port) ELSE src_ip END"
    return base(spark, sf_dir).select("event_id", tags.tag_variable(F.expr(text)).alias("t")).select("event_id", "t.ip", "t.port", "t.src_ip", "t.src_port", "t.dst_ip", "t.dst_port")


@query("sql_parsers", f"""{SQL_BASE} SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'kv_syslog' WHEN 1 THEN 'cef' WHEN 2 THEN 'leef' WHEN 3 THEN 'syslog5424' WHEN 4 THEN 'json' ELSE 'csv_like' END AS label, src_ip AS src,
  CASE event_id % 6 WHEN 4 THEN NULL ELSE e.iso END AS stamp, CASE event_id % 6 WHEN 1 THEN e.at END AS seen, CASE event_id % 6 WHEN 4 THEN iso END AS epoch, '192.168.1.' || (1 + event_id % 250) AS ip, 'ip_port' AS kind FROM e""")
def sql_parsers(spark, sf_dir):
    """The parsers, shapes and stamps as SQL functions."""
    sql_functions.register(spark)
    rows = base(spark, sf_dir).selectExpr("event_id", "CASE event_id % 6 " + " ".join(f"WHEN {i} THEN {LINES[s]}" for i, s in enumerate(_SHAPES)) + " END AS raw", "concat(dst_ip, ':', dst_port) AS token")
    name = f"sql_parsers_{abs(hash(sf_dir))}"
    rows.createOrReplaceTempView(name)
    return spark.sql(f"""
      WITH p AS (SELECT event_id, raw, token, log_sniff(raw) AS label, CASE event_id % 6 WHEN 0 THEN log_parse_kv(raw) WHEN 1 THEN log_parse_cef(raw) WHEN 2 THEN log_parse_leef(raw) WHEN 3 THEN log_parse_rfc5424(raw) WHEN 4 THEN log_parse_json(raw)
        ELSE log_parse_csv('{CSV_HEADER}', raw) END AS f FROM {name})
      SELECT event_id, label, coalesce(f['srcip'], f['src'], f['srcIP'], f['srcaddr'], f['source_ip']) AS src,
        log_timestamp(coalesce(concat(f['date'], ' ', f['time']), f['devTime'], f['timestamp'], log_profile(f['syslog_prefix']).timestamp), TIMESTAMP'{NOW}') AS stamp,
        log_profile(CASE event_id % 6 WHEN 1 THEN f['syslog_prefix'] END).timestamp AS seen, log_epoch(f['start']) AS epoch, log_tag(token).ip AS ip, log_tag(token).guessed_type AS kind FROM p""")


# --- templates and codebooks ----------------------------------------------------------------------

def mined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.train(free_lines(spark, sf_dir))


@query("template_regex", r"""SELECT DISTINCT CASE event_id % 3 WHEN 0 THEN '^\Qsession opened for user \E(.+?)\Q by root from \E(.+?)$' WHEN 1 THEN '^\Qinterface \E(.+?)\Q dropped \E(.+?)\Q packets today at gate\E$' ELSE '^\Qcache flush finished took \E(.+?)\Q ms\E$' END AS pattern FROM events""")
def template_regex(spark, sf_dir):
    return mined(spark, sf_dir).select(templates.pattern_of(F.col("template")).alias("pattern")).distinct()


@query("template_roles", f"SELECT {_TEMPLATE} AS template, CASE event_id % 3 WHEN 0 THEN 'unknown,src_ip' WHEN 1 THEN 'unknown,src_port' ELSE 'src_port' END AS roles, 'app0' AS learned_from_source FROM events GROUP BY ALL")
def template_roles(spark, sf_dir):
    return templates.promote(mined(spark, sf_dir)).select("template", F.array_join("roles", ",").alias("roles"), "learned_from_source")


@query("codebook_add", f"SELECT {_TEMPLATE} AS template FROM events WHERE event_id % 3 > 0 GROUP BY ALL")
def codebook_add(spark, sf_dir):
    """What a codebook lacks is added; what it holds stays out."""
    found = mined(spark, sf_dir)
    have = templates.promote(found.filter("template LIKE 'session%'"))
    return templates.promote(found, existing=have).select("template")


@query("codebook_saved", f"SELECT sha1({_TEMPLATE})[1:16] AS signature, count(*) AS sample_count, count(*) > 0 AS matches FROM events WHERE event_id % 2 = 0 GROUP BY {_TEMPLATE}")
def codebook_saved(spark, sf_dir):
    """A codebook written as JSON and read back, and whether its entries match their own sample lines."""
    with tempfile.TemporaryDirectory() as folder:
        templates.save_codebook(templates.promote(mined(spark, sf_dir)), f"{folder}/book.json")
        book = templates.load_codebook(spark, f"{folder}/book.json")
    rows = book.select(F.lit("/x").alias("source_path"), F.lit("x").alias("source_name"), F.lit(1).cast("bigint").alias("line_number"), F.col("sample_line").alias("raw"))
    hits = templates.match(rows, mined(spark, sf_dir).limit(0), book).select(F.substring("cluster_id", 9, 16).alias("signature"), "learned")
    return book.join(hits, "signature").select("signature", "sample_count", F.col("learned").alias("matches"))


@query("review_summary", f"SELECT printf('[%5dx from %-28s]  %s', count(*), 'app0', {_TEMPLATE}) AS line FROM events WHERE event_id % 2 = 0 GROUP BY {_TEMPLATE}")
def review_summary(spark, sf_dir):
    return templates.review_summary(templates.promote(mined(spark, sf_dir)))


@query("miner_resume", f"SELECT 'app' || (event_id % 2) AS source_name, {_TEMPLATE} AS template, count(*) AS size, min(event_id) + 1 AS example_line FROM events GROUP BY ALL")
def miner_resume(spark, sf_dir):
    """Templates of the first lines, gone on from with the others: as one run over all lines."""
    rows = free_lines(spark, sf_dir)
    first = templates.train(rows.filter("line_number <= 300"))
    return templates.train(rows.filter("line_number > 300"), known=first).select("source_name", "template", "size", "example_line")


# --- files ----------------------------------------------------------------------------------------

def _renamed(spark: SparkSession, folder: str, name: str) -> str:
    """A folder with the one written part, under another name."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = next(x.getPath() for x in store.listStatus(where) if x.getPath().getName().startswith("part-"))
    out = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}-named/{name}")
    store.mkdirs(out.getParent())
    store.rename(part, out)
    return f"{folder}-named"


def _written(spark: SparkSession, sf_dir: str, shape: str, name: str, gzip: bool = False) -> str:
    folder = f"{shared_folder(spark)}/{shape}"
    rows = base(spark, sf_dir).repartition(1).sortWithinPartitions("event_id").selectExpr(f"{LINES[shape]} AS value")
    rows.write.option("compression", "gzip" if gzip else "none").text(folder)
    return _renamed(spark, folder, name)


@query("read_misnamed_gzip", f"{SQL_BASE} SELECT event_id + 1 AS line_number, action, 'packed.old' AS source_name FROM e")
def misnamed_gzip(spark, sf_dir):
    """A gzip file without the extension, known by its bytes, its lines' numbers as they were."""
    return events(read_lines(spark, _written(spark, sf_dir, "kv_syslog", "packed.old.log", gzip=True))).select("lineage.line_number", "action", "lineage.source_name")


@query("read_folder", f"{SQL_BASE} SELECT event_id + 1 AS line_number, action, 'one' AS source_name, 'kv_syslog' AS source_format FROM e UNION ALL SELECT event_id + 1, action, 'two.log', 'json' FROM e")
def read_folder(spark, sf_dir):
    """Several files, one packed, each with its own format, name and numbers."""
    found = read_lines(spark, _written(spark, sf_dir, "kv_syslog", "one.log"), _written(spark, sf_dir, "json", "two.log.gz", gzip=True))
    return events(found).select("lineage.line_number", "action", "lineage.source_name", "source_format")


@query("read_invalid_utf8", "SELECT event_id + 1 AS line_number, CASE event_id % 2 WHEN 0 THEN 'a' || chr(65533) || 'b' || event_id ELSE 'é' || event_id END AS raw FROM events")
def invalid_utf8(spark, sf_dir):
    folder = f"{shared_folder(spark)}/bytes"
    bytes_ = "CASE event_id % 2 WHEN 0 THEN concat(X'61FF62', encode(cast(event_id AS string), 'utf-8')) ELSE encode(concat('é', event_id), 'utf-8') END"
    base(spark, sf_dir).repartition(1).sortWithinPartitions("event_id").selectExpr(f"CAST({bytes_} AS STRING) AS value").write.text(folder)
    return read_lines(spark, folder).select("line_number", "raw")


# --- sinks ----------------------------------------------------------------------------------------

#: The lines of LINES in SQL over SQL_BASE.
RAW = {
    "kv_syslog": "'date=' || split_part(e.at, ' ', 1) || ' time=' || split_part(e.at, ' ', 2) || ' type=\"' || event_type || '\" action=\"' || word || '\" srcip=' || src_ip || ' srcport=' || src_port || ' dstip=' || dst_ip || ' dstport=' || dst_port || ' proto=' || proto || ' sentbyte=' || sent || ' rcvdbyte=' || received || ' user=\"user ' || user_id || '\" msg=\"event ' || event_id || ' seen\"'",
    "cef": "e.at || ' fw1 CEF:0|Acme|Wall|1.2|' || event_id || '|' || event_type || '|5|act=' || word || ' src=' || src_ip || ' spt=' || src_port || ' dst=' || dst_ip || ' dpt=' || dst_port || ' proto=' || proto || ' out=' || sent || ' in=' || received || ' duser=user ' || user_id || ' cat=' || event_type || ' msg=event ' || event_id || ' seen'",
    "leef": "e.at || ' fw2 LEEF:2.0|Acme|Wall|1.2|' || word || '|^|devTime=' || e.at || '^src=' || src_ip || '^srcPort=' || src_port || '^dst=' || dst_ip || '^dstPort=' || dst_port || '^proto=' || proto || '^bytesOut=' || sent || '^bytesIn=' || received || '^usrName=user ' || user_id || '^cat=' || event_type",
    "syslog5424": "'<134>1 ' || replace(e.at, ' ', 'T') || 'Z gw1 flowd ' || user_id || ' ID7 [flow@1 srcIP=\"' || src_ip || '\" srcPort=\"' || src_port || '\" dstIP=\"' || dst_ip || '\" dstPort=\"' || dst_port || '\" proto=\"' || proto || '\"] [more@1 action=\"' || word || '\" bytesSent=\"' || sent || '\" bytesRecv=\"' || received || '\" user=\"user ' || user_id || '\"] event ' || event_id || ' seen'",
    "json": "'{\"start\": ' || CAST(epoch(date_trunc('second', ts)) AS BIGINT) || ', \"action\": \"' || word || '\", \"srcaddr\": \"' || src_ip || '\", \"srcport\": ' || src_port || ', \"dstaddr\": \"' || dst_ip || '\", \"dstport\": \"' || dst_port || '\", \"protocol\": ' || proto || ', \"bytes\": ' || sent || ', \"packets\": ' || packets || '}'",
    "csv": "e.at || ',' || word || ',' || src_ip || ',' || src_port || ',' || dst_ip || ',' || dst_port || ',' || proto || ',' || sent || ',' || received || ',' || packets",
}
_SHAPE = "CASE event_id % 6 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_SHAPES)) + " END"
SQL_RAW = f"""{SQL_MIXED}{_FIRST},
raws AS (SELECT {_SHAPE} AS shape, event_id // 6 + 1 AS n, CASE event_id % 6 {' '.join(f'WHEN {i} THEN {RAW[s]}' for i, s in enumerate(_SHAPES))} END AS raw
  FROM (SELECT *, CASE event_id % 3 WHEN 0 THEN '6' WHEN 1 THEN '17' ELSE '1' END AS proto FROM e) e),
whole AS (SELECT first.*, raw, substr(sha256(path || ':' || line_number || ':' || raw), 1, 24) AS event_id FROM first JOIN raws ON shape = source_format AND n = line_number)"""
_NULLS = ["severity", "host", "process", "pid"]
_KEPT = ["event_id", "timestamp", "vendor", "source_format", "event_type", "action", "src_ip", "src_port", "dst_ip", "dst_port", "protocol", "bytes_sent", "bytes_received", "packets", "user", "message", "confidence", "raw"]
_WHOLE = ", ".join(f'"{c}"' for c in _KEPT) + ", " + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in _NULLS)


@query("flatten_all", f"{SQL_RAW} SELECT {_WHOLE}, event_id AS lineage_event_id, path AS lineage_source_path, source_format AS lineage_source_name, line_number AS lineage_line_number FROM whole")
def flatten_all(spark, sf_dir):
    """All of the 27 columns but the time of reading."""
    return sinks.flatten(mixed_events(spark, sf_dir)).drop("lineage_ingested_at")


@query("jsonl_events", f"{SQL_RAW} SELECT {_WHOLE}, \"timestamp\" AS stamp, event_id AS lineage_id, 24 AS keys FROM whole")
def jsonl_events(spark, sf_dir):
    """The JSON lines (which are also the index's documents), read back field by field; nulls are written."""
    schema = ", ".join(f"`{c}` " + ("double" if c == "confidence" else "bigint" if c.endswith("port") or c.startswith("bytes") or c == "packets" else "string") for c in [*_KEPT, *_NULLS])
    doc = F.from_json("value", f"{schema}, `@timestamp` string, lineage struct<event_id: string>")
    found = sinks.jsonl(mixed_events(spark, sf_dir)).select(doc.alias("d"), F.size(F.json_object_keys("value")).alias("keys"))
    return found.select(*(F.col("d")[c].alias(c) for c in [*_KEPT, *_NULLS]), F.col("d")["@timestamp"].alias("stamp"), F.col("d.lineage.event_id").alias("lineage_id"), "keys")


@query("per_source_first", f"""{SQL_RAW} SELECT path AS source_path, source_format AS source_name, count(*) AS events, CAST(min(confidence) AS DOUBLE) AS avg_confidence, count(*) AS high, CAST(0 AS BIGINT) AS medium, CAST(0 AS BIGINT) AS low,
  arg_min(event_id, line_number) AS first_event_id FROM whole GROUP BY path, source_format""")
def per_source_first(spark, sf_dir):
    return summary.per_source(mixed_events(spark, sf_dir))


@query("totals_all", f"""{SQL_MIXED} SELECT count(*) AS events, count(*) FILTER (action = 'deny') AS denied, 100.0 * count(*) FILTER (action = 'deny') / count(*) AS deny_rate, round(avg(confidence), 6) AS avg_confidence,
count(DISTINCT src_ip) AS src_ips, count(DISTINCT vendor) AS vendors, count(DISTINCT source_format) AS formats, count(DISTINCT substr("timestamp", 1, 4)) AS years FROM ev""")
def totals_all(spark, sf_dir):
    return summary.totals(mixed_events(spark, sf_dir)).withColumn("avg_confidence", F.round("avg_confidence", 6))


_KEYWORDS = ["event_id", "vendor", "source_format", "event_type", "action", "severity", "protocol", "user", "host", "process", "pid", "lineage.event_id", "lineage.source_path", "lineage.source_name"]
_MAPPED = {"keyword": _KEYWORDS, "date": ["timestamp", "@timestamp", "lineage.ingested_at"], "ip": ["src_ip", "dst_ip"], "integer": ["src_port", "dst_port"], "long": ["bytes_sent", "bytes_received", "packets", "lineage.line_number"], "text": ["message", "raw"], "float": ["confidence"]}


@query("index_mapping", "SELECT * FROM (VALUES " + ", ".join(f"('{f}', '{k}')" for k, fields in _MAPPED.items() for f in fields) + ") t(field, type)")
def index_mapping(spark, sf_dir):
    own = sinks.index_mapping()["mappings"]["properties"]
    nested = own.pop("lineage")["properties"]
    rows = [(k, v["type"]) for k, v in own.items()] + [(f"lineage.{k}", v["type"]) for k, v in nested.items()]
    return spark.createDataFrame(rows, "field string, type string")


@query("dashboard_numbers", f"""{SQL_MIXED}, a AS (SELECT action AS k, count(*) AS n FROM ev GROUP BY ALL)
SELECT 'events' AS name, format('{{:,}}', count(*)) AS value FROM ev UNION ALL SELECT 'source addresses', format('{{:,}}', count(DISTINCT src_ip)) FROM ev UNION ALL SELECT 'formats', '6' UNION ALL SELECT 'vendors', '5'
UNION ALL SELECT 'action ' || k, printf('%.1f%%', 100.0 * n / (SELECT sum(n) FROM a)) FROM a UNION ALL SELECT 'rows', '25'""")
def dashboard_numbers(spark, sf_dir):
    """What the page shows: its totals, the shares of the ring, and the number of its first events."""
    page = sinks.dashboard(mixed_events(spark, sf_dir))
    shown = [(k, v) for k, v in re.findall(r"<section><h2>([a-z ]+)</h2><b>([^<]+)</b>", page) if k not in ("deny rate", "average confidence")]
    ring = re.search(r"<h2>Actions</h2>.*?<ul>(.*?)</ul>", page)[1]
    shares = [(f"action {k}", v) for k, v in re.findall(r">([a-z]+) ([\d.]+%)<", ring)]
    rows = [("rows", str(page.split("<tbody>")[1].split("</tbody>")[0].count("<tr>")))]
    return spark.createDataFrame(shown + shares + rows, "name string, value string")


# --- runs and streams -----------------------------------------------------------------------------

@query("run_twice", f"{SQL_BASE} SELECT 'kv' AS source_name, action, 2 * count(*) AS events, 2 AS files_processed FROM e GROUP BY action")
def run_twice(spark, sf_dir):
    """Two whole runs with one state: the events of both, and the registry's count of files."""
    folder = shared_folder(spark)
    path = _written(spark, sf_dir, "kv_syslog", "kv.log")
    both = [run.process(spark, [path], f"{folder}/out{i}", f"{folder}/state") for i in range(2)]
    counted = both[0]["events"].unionByName(both[1]["events"]).groupBy("lineage.source_name", "action").agg(F.count("*").alias("events"))
    return counted.join(F.broadcast(both[1]["registry"].select("source_name", F.col("files_processed").cast("int").alias("files_processed"))), "source_name")


@query("onboard_samples", "SELECT * FROM (VALUES ('kv', 'kv_syslog', 'nothing'), ('free', 'unknown', 'review of templates')) t(source_name, format, needs)")
def onboard_samples(spark, sf_dir):
    folder = shared_folder(spark)
    free_lines(spark, sf_dir).select("raw").repartition(1).write.text(f"{folder}/free")
    found = [run.onboard(spark, _written(spark, sf_dir, "kv_syslog", "kv.log"), "kv", f"{folder}/state"), run.onboard(spark, f"{folder}/free", "free", f"{folder}/state")]
    return spark.createDataFrame([(x["source_name"], x["format"], x["needs"]) for x in found], "source_name string, format string, needs string")


@query("stream_windows", f"{SQL_BASE} SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS start, action, count(*) AS events FROM e GROUP BY ALL")
def stream_windows(spark, sf_dir):
    """Events per five minutes and action by a stream that meets each event twice."""
    folder = shared_folder(spark)
    rows = base(spark, sf_dir).selectExpr("cast(event_id AS string) AS event_id", "cast(ts AS timestamp) AS event_ts", "CASE word WHEN 'accept' THEN 'allow' WHEN 'login' THEN 'auth' WHEN 'allow' THEN 'allow' WHEN 'deny' THEN 'deny' ELSE 'other' END AS action")
    rows.unionByName(rows).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    once = distinct_events(stream, "100 days")
    once.writeStream.format("parquet").option("checkpointLocation", f"{folder}/once-state").trigger(availableNow=True).start(f"{folder}/once").awaitTermination()

    def store(batch: DataFrame, _: int) -> None:
        batch.select("window.start", "action", "events").write.mode("overwrite").parquet(f"{folder}/windows")

    counted = windowed_counts(spark.readStream.schema(rows.schema).parquet(f"{folder}/once"))
    counted.writeStream.outputMode("complete").foreachBatch(store).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/windows").withColumn("start", F.col("start").cast("timestamp_ntz"))

"""Every query of the engine by name, and SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelog.codebooks import codebook_table
from shapelog.functions import profile, scalars, sniff, tags
from shapelog.functions import sql as sql_functions
from shapelog.functions.timestamps import normalize_timestamp
from shapelog.operators import coded, onboard, summary, templates
from shapelog.operators.events import events, parsed_lines, structured_events
from shapelog.operators.formats import file_formats
from shapelog.plans.render import COLUMNS, EXPECTED, LINES, SQL_BASE, base, event_columns, expected, lines, mixed_lines
from shapelog.sources import sinks
from shapelog.sources.lines import read_lines
from shapelog.sources.shared import shared_folder
from shapelog.streaming.events import stream_events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: The day that shapes without a year are read on.
NOW = "2024-06-30 12:00:00"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


# --- one parser and normalizer each -------------------------------------------------------------

for _shape in LINES:
    @query(f"{_shape.removesuffix('_syslog').replace('syslog', 'rfc')}_events", f"{SQL_BASE}\n{expected(_shape)}")
    def shape_events(spark, sf_dir, shape=_shape):
        number = "event_id + 2" if shape == "csv" else "event_id + 1"  # a table's rows count from after its header
        return event_columns(structured_events(parsed_lines(lines(spark, sf_dir, shape, number), shapes=[shape]), shapes=[shape]))


# --- coded messages -----------------------------------------------------------------------------

ASA = """CASE event_id % 8
  WHEN 0 THEN concat('%ASA-6-302013: Built inbound TCP connection ', event_id, ' for outside:', src_ip, '/', src_port, ' (1.2.3.4/80) to inside:', dst_ip, '/', dst_port)
  WHEN 1 THEN concat('%ASA-6-302014: Teardown UDP connection ', event_id, ' for outside:', src_ip, '/', src_port, ' to inside:', dst_ip, '/', dst_port, ' duration 0:01:02 bytes ', sent)
  WHEN 2 THEN concat('%ASA-4-106023: Deny tcp src outside:', src_ip, '/', src_port, ' dst inside:', dst_ip, '/', dst_port, ' by access-group "outside_in"')
  WHEN 3 THEN concat('%ASA-1-106021: Deny protocol reverse path check from ', src_ip, ' to ', dst_ip, ' on interface outside')
  WHEN 4 THEN concat('%ASA-3-313001: Denied ICMP type=8, code=0 from ', src_ip, ' on interface outside')
  WHEN 5 THEN concat('%ASA-6-113004: AAA user authentication Successful : server = ', dst_ip, ' : user = u', user_id)
  WHEN 6 THEN concat('%ASA-6-113005: AAA user authentication Rejected : reason = bad password : server = ', dst_ip, ' : user = u', user_id)
  ELSE concat('%ASA-5-111008: User ', chr(39), 'u', user_id, chr(39), ' executed the ', chr(39), 'show run', chr(39), ' command') END"""
FTD = """CASE event_id % 3
  WHEN 0 THEN concat('%FTD-6-430001: AC_RuleAction: Allow, Rule: r1, SrcIP: ', src_ip, ', DstIP: ', dst_ip, ', SrcPort: ', src_port, ', DstPort: ', dst_port, ', Protocol: TCP')
  WHEN 1 THEN concat('%FTD-4-430002: AC_RuleAction: Block, Rule: r2, SrcIP: ', src_ip, ', DstIP: ', dst_ip, ', SrcPort: ', src_port, ', DstPort: ', dst_port, ', Protocol: udp')
  ELSE concat('%FTD-1-430003: Intrusion Event sid 7, SrcIP: ', src_ip, ', DstIP: ', dst_ip, ', SrcPort: ', src_port, ', DstPort: ', dst_port) END"""
CODED_COLUMNS = ["line_number", "timestamp", "vendor", "event_type", "action", "src_ip", "src_port", "dst_ip", "dst_port", "protocol", "bytes_sent", "user", "message", "confidence"]


def coded_lines(spark: SparkSession, sf_dir: str, message: str) -> DataFrame:
    stamp = "concat(date_format(to_date(substring(at, 1, 10)), 'MMM d yyyy'), ' ', substring(at, 12, 8))"
    return base(spark, sf_dir).select(
        F.lit("/logs/coded.log").alias("source_path"), F.lit("coded").alias("source_name"), (F.col("event_id") + 1).alias("line_number"),
        F.concat(F.lit("<164>"), F.expr(stamp), F.lit(" fw9 : "), F.expr(message)).alias("raw"), F.lit("coded_syslog").alias("format"),
    )


def coded_events(spark: SparkSession, sf_dir: str, message: str) -> DataFrame:
    found = structured_events(parsed_lines(coded_lines(spark, sf_dir, message), shapes=["coded_syslog"]), shapes=["coded_syslog"])
    return found.withColumn("line_number", F.col("lineage.line_number")).select(*CODED_COLUMNS)


def _pick(key: str, *values: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


@query("coded_asa", f"""{SQL_BASE}
SELECT event_id + 1 AS line_number, iso AS "timestamp", 'cisco' AS vendor,
  {_pick('event_id % 8', "'connection'", "'connection'", "'traffic'", "'traffic'", "'traffic'", "'auth'", "'auth'", "'admin'")} AS event_type,
  {_pick('event_id % 8', "'allow'", "'other'", "'deny'", "'deny'", "'deny'", "'allow'", "'deny'", "'other'")} AS action,
  CASE WHEN event_id % 8 <= 4 THEN src_ip END AS src_ip, CAST(CASE WHEN event_id % 8 <= 2 THEN src_port END AS BIGINT) AS src_port,
  CASE WHEN event_id % 8 <= 3 THEN dst_ip END AS dst_ip, CAST(CASE WHEN event_id % 8 <= 2 THEN dst_port END AS BIGINT) AS dst_port,
  CASE event_id % 8 WHEN 0 THEN 'tcp' WHEN 1 THEN 'udp' WHEN 2 THEN 'tcp' END AS protocol, CASE WHEN event_id % 8 = 1 THEN sent END AS bytes_sent,
  CASE WHEN event_id % 8 >= 5 THEN 'u' || user_id END AS "user",
  {_pick('event_id % 8', "'Connection built'", "'Connection teardown'", "'Denied by access-group'", "'Denied by reverse path check (anti-spoofing)'", "'Denied ICMP'", "'AAA authentication successful'", "'AAA authentication rejected'", "'Admin command executed'")} AS message,
  CAST(0.9 AS DOUBLE) AS confidence FROM e""")
def coded_asa(spark, sf_dir):
    return coded_events(spark, sf_dir, ASA)


@query("coded_ftd", f"""{SQL_BASE}
SELECT event_id + 1 AS line_number, iso AS "timestamp", 'cisco_firepower' AS vendor, 'traffic' AS event_type, {_pick('event_id % 3', "'allow'", "'deny'", "'deny'")} AS action,
  src_ip, CAST(src_port AS BIGINT) AS src_port, dst_ip, CAST(dst_port AS BIGINT) AS dst_port, CASE event_id % 3 WHEN 0 THEN 'tcp' WHEN 1 THEN 'udp' END AS protocol,
  CAST(NULL AS BIGINT) AS bytes_sent, CAST(NULL AS VARCHAR) AS "user",
  {_pick('event_id % 3', "'Connection allowed by access control policy'", "'Connection blocked by access control policy'", "'Connection blocked by intrusion policy'")} AS message, CAST(0.9 AS DOUBLE) AS confidence FROM e""")
def coded_ftd(spark, sf_dir):
    return coded_events(spark, sf_dir, FTD)


_EMPTY = 'CAST(NULL AS VARCHAR) AS src_ip, CAST(NULL AS BIGINT) AS src_port, CAST(NULL AS VARCHAR) AS dst_ip, CAST(NULL AS BIGINT) AS dst_port, CAST(NULL AS VARCHAR) AS protocol, CAST(NULL AS BIGINT) AS bytes_sent, CAST(NULL AS VARCHAR) AS "user"'


@query("coded_unknown_code", f"""{SQL_BASE} SELECT event_id + 1 AS line_number, iso AS "timestamp", CASE event_id % 2 WHEN 0 THEN 'cisco' ELSE 'pix' END AS vendor, 'unknown_code' AS event_type, 'other' AS action, {_EMPTY}, CAST(NULL AS VARCHAR) AS message, CAST(0.3 AS DOUBLE) AS confidence FROM e""")
def coded_unknown_code(spark, sf_dir):
    return coded_events(spark, sf_dir, "concat(CASE event_id % 2 WHEN 0 THEN '%ASA-6-999999: ' ELSE '%PIX-6-302013: ' END, 'something else ', event_id)")


@query("coded_body_drift", f"""{SQL_BASE} SELECT event_id + 1 AS line_number, iso AS "timestamp", 'cisco' AS vendor, 'traffic' AS event_type, 'deny' AS action, {_EMPTY}, 'Denied by access-group' AS message, CAST(0.5 AS DOUBLE) AS confidence FROM e""")
def coded_body_drift(spark, sf_dir):
    return coded_events(spark, sf_dir, "concat('%ASA-4-106023: Refused ', src_ip, ' at ', dst_ip)")


@query("codebook_join", f"""{SQL_BASE} SELECT event_id, {_pick('event_id % 3', "'allow'", "'deny'", "CAST(NULL AS VARCHAR)")} AS action, CASE event_id % 3 WHEN 0 THEN src_ip END AS src_ip, CASE event_id % 3 WHEN 0 THEN 'u' || user_id END AS "user" FROM e""")
def codebook_join(spark, sf_dir):
    body = "CASE event_id % 3 WHEN 0 THEN concat('Built inbound TCP connection 1 for a:', src_ip, '/1 (1.2.3.4/80) to b:', dst_ip, '/2') WHEN 1 THEN 'drifted' ELSE 'other' END"
    rows = base(spark, sf_dir).selectExpr("event_id", "user_id", "'ASA' AS prefix", "CASE event_id % 3 WHEN 0 THEN '302013' WHEN 1 THEN '106023' ELSE '1' END AS code", f"{body} AS body")
    found = coded.join_codebook(rows, codebook_table(spark))
    return found.selectExpr("event_id", "action", "fields['src_ip'] AS src_ip", "CASE WHEN fields IS NOT NULL THEN concat('u', user_id) END AS user")


# --- shapes of lines and files ------------------------------------------------------------------

MIX = {"json": LINES["json"], "csv_like": LINES["csv"], "kv_syslog": LINES["kv_syslog"], "cef": LINES["cef"], "leef": LINES["leef"], "syslog5424": LINES["syslog5424"], "coded_syslog": f"concat('<164>Jan 1 2024 00:00:00 fw : ', {ASA})", "unknown": "concat('user ', user_id, ' came from uid=0 and left a=1 b=2 at last')", "empty": "'  '"}


@query("sniff_lines", "SELECT event_id, CASE event_id % 9 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(MIX)) + " END AS label FROM events")
def sniff_lines(spark, sf_dir):
    raw = "CASE event_id % 9 " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(MIX.values())) + " END"
    return base(spark, sf_dir).select("event_id", sniff.sniff_line(F.expr(raw)).alias("label"))


@query("sniff_files", f"""{SQL_BASE}, n AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, event_id FROM e),
labels AS (SELECT user_id, n, CASE event_id % 3 WHEN 0 THEN 'json' WHEN 1 THEN 'cef' ELSE 'leef' END AS label FROM n WHERE n <= 6),
votes AS (SELECT user_id, label, count(*) AS c, min(n) AS f FROM labels GROUP BY ALL)
SELECT 'u' || user_id AS source_name, label AS format FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, f) AS r FROM votes) WHERE r = 1""")
def sniff_files(spark, sf_dir):
    raw = f"CASE event_id % 3 WHEN 0 THEN {LINES['json']} WHEN 1 THEN {LINES['cef']} ELSE {LINES['leef']} END"
    rows = base(spark, sf_dir).selectExpr("concat('u', user_id) AS source_name", f"{raw} AS raw", "event_id", "concat('/logs/', user_id) AS source_path")
    numbered = rows.withColumn("line_number", F.expr("row_number() OVER (PARTITION BY source_path ORDER BY event_id)"))
    return file_formats(numbered).select("source_name", "format")


@query("sniff_csv_files", "SELECT 'f' || k AS source_name, CASE k WHEN 0 THEN 'csv' ELSE 'unknown' END AS format FROM (SELECT DISTINCT user_id % 2 AS k FROM events)")
def sniff_csv_files(spark, sf_dir):
    rows = base(spark, sf_dir).selectExpr("user_id % 2 AS k", "event_id", f"CASE WHEN user_id % 2 = 1 AND event_id % 2 = 0 THEN concat({LINES['csv']}, ',more') ELSE {LINES['csv']} END AS raw")
    header = spark.range(2).select(F.col("id").alias("k"), F.lit(-1).cast("bigint").alias("event_id"), F.when(F.col("id") == 0, "a,b,c,d,e,f,g,h,i,j").otherwise("one, two").alias("raw"))
    named = rows.unionByName(header).selectExpr("concat('f', k) AS source_name", "concat('/logs/', k) AS source_path", "raw", "event_id")
    return file_formats(named.withColumn("line_number", F.expr("row_number() OVER (PARTITION BY source_path ORDER BY event_id)"))).select("source_name", "format")


# --- identity, timestamps, scalars, profile -----------------------------------------------------

@query("event_id", "SELECT doc_id, substr(sha256('/docs/' || lang || ':' || doc_id || ':' || coalesce(text, '')), 1, 24) AS id FROM documents")
def event_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", scalars.event_id(F.concat(F.lit("/docs/"), "lang"), F.col("doc_id"), F.coalesce("text", F.lit(""))).alias("id"))


_MONTH = "date_format(to_date(substring(at, 1, 10)), 'MMM')"
_NOYEAR = "strftime(ts, '2024-%m-%dT%H:%M:%S.000Z')"
# Of each timestamp shape: how a line has it (Spark) and what it must become (DuckDB).
STAMPS = {
    "iso": ("concat(replace(at, ' ', 'T'), ',123456+05:30')", "strftime(ts, '%Y-%m-%dT%H:%M:%S.123Z')"),
    "bsd_year": (f"concat({_MONTH}, ' ', cast(substring(at, 9, 2) AS int), ' ', substring(at, 1, 4), ' ', substring(at, 12, 8))", "iso"),
    "bsd_noyear": (f"concat({_MONTH}, '  ', cast(substring(at, 9, 2) AS int), ' ', substring(at, 12, 8))", _NOYEAR),
    "android": ("concat(substring(at, 6, 14), '.5')", "strftime(ts, '2024-%m-%dT%H:%M:%S.500Z')"),
    "bracket": ("concat('[', replace(substring(at, 6, 5), '-', '.'), ' ', substring(at, 12, 8), ']')", _NOYEAR),
    "slash": ("concat(replace(substring(at, 3, 8), '-', '/'), ' ', substring(at, 12, 8))", "iso"),
    "compact": ("concat(replace(substring(at, 3, 8), '-', ''), ' ', replace(substring(at, 12, 8), ':', ''))", "iso"),
    "dashed": ("concat(replace(substring(at, 1, 10), '-', ''), '-', cast(substring(at, 12, 2) AS int), ':', cast(substring(at, 15, 2) AS int), ':', cast(substring(at, 18, 2) AS int), ':7')", "strftime(ts, '%Y-%m-%dT%H:%M:%S.700Z')"),
    "date": ("replace(substring(at, 1, 10), '-', '.')", "strftime(ts, '%Y-%m-%dT00:00:00.000Z')"),
    "epoch": ("cast(unix_seconds(cast(concat(at, 'Z') AS timestamp)) AS string)", "iso"),
    "invalid": ("CASE event_id % 4 WHEN 0 THEN concat(substring(at, 1, 17), '60') WHEN 1 THEN '2023-02-29 00:00:00' WHEN 2 THEN concat(substring(at, 1, 10), '-10.11.12.5') ELSE 'Foo 1 10:00:00' END", "CAST(NULL AS VARCHAR)"),
}
for _name, (_text, _want) in STAMPS.items():
    @query(f"ts_{_name}", f"{SQL_BASE} SELECT event_id, {_want} AS stamp FROM e")
    def stamps(spark, sf_dir, text=_text):
        return base(spark, sf_dir).select("event_id", normalize_timestamp(F.expr(text), F.to_timestamp(F.lit(NOW))).alias("stamp"))


@query("to_int", "SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_id WHEN 1 THEN -event_id WHEN 2 THEN event_id END AS n FROM events")
def to_int(spark, sf_dir):
    text = "CASE event_id % 5 WHEN 0 THEN cast(event_id AS string) WHEN 1 THEN concat(' -', event_id, chr(9)) WHEN 2 THEN concat('+', event_id) WHEN 3 THEN concat(event_id, '.5') ELSE 'n/a' END"
    return base(spark, sf_dir).select("event_id", scalars.to_int(F.expr(text)).alias("n"))


@query("action_norm", f"{SQL_BASE} SELECT event_id, action FROM e")
def action_norm(spark, sf_dir):
    return base(spark, sf_dir).select("event_id", scalars.normalize_action(F.expr("concat(' ', upper(word), ' ')")).alias("action"))


@query("action_guess", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'allow' WHEN 1 THEN 'deny' WHEN 2 THEN 'auth' ELSE 'other' END AS action FROM events")
def action_guess(spark, sf_dir):
    text = "CASE event_id % 4 WHEN 0 THEN 'was blocked, then Accept it' WHEN 1 THEN 'pkt DROPPED here' WHEN 2 THEN 'login: failed' ELSE 'permitted denying' END"
    return base(spark, sf_dir).select("event_id", scalars.guess_action(F.expr(text)).alias("action"))


@query("protocol_norm", f"{SQL_BASE} SELECT event_id, CASE event_id % 2 WHEN 0 THEN protocol ELSE 'gre' END AS protocol FROM e")
def protocol_norm(spark, sf_dir):
    return base(spark, sf_dir).select("event_id", scalars.normalize_protocol(F.expr("CASE event_id % 2 WHEN 0 THEN concat(proto, ' ') ELSE 'GRE' END")).alias("protocol"))


@query("conf_bucket", "SELECT event_id, CASE WHEN event_id % 101 >= 80 THEN 'high' WHEN event_id % 101 >= 40 THEN 'medium' ELSE 'low' END AS bucket FROM events")
def conf_bucket(spark, sf_dir):
    return base(spark, sf_dir).select("event_id", scalars.confidence_bucket(F.expr("event_id % 101 / 100D")).alias("bucket"))


@query("ipv4_scan", f"{SQL_BASE} SELECT event_id, src_ip || ';' || dst_ip AS ips FROM e")
def ipv4_scan(spark, sf_dir):
    text = "concat('from ', src_ip, ':80 to [', dst_ip, '] via ', src_ip, ' not 300.1.1.1 or 1.2.3')"
    return base(spark, sf_dir).select("event_id", F.array_join(scalars.ipv4s(F.expr(text)), ";").alias("ips"))


@query("severity_scan", r"""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'warning' WHEN 1 THEN 'debug' WHEN 2 THEN 'error' WHEN 3 THEN 'critical' WHEN 4 THEN 'info' END AS severity FROM events""")
def severity_scan(spark, sf_dir):
    text = "CASE event_id % 6 WHEN 0 THEN 'a Warning: x' WHEN 1 THEN '1702  2395 D WindowManager: error' WHEN 2 THEN '[ERR] y' WHEN 3 THEN 'FATAL' WHEN 4 THEN 'notice of INFO' ELSE 'informal terror' END"
    return base(spark, sf_dir).select("event_id", profile.extract_severity(F.expr(text)).alias("severity"))


@query("document_severity", r"""WITH l AS (SELECT doc_id, lower(coalesce(nullif(regexp_extract(text, '(?:^|[^\p{L}\p{N}_])[0-9]+[\t-\r ]+[0-9]+[\t-\r ]+([VDIWEF])[\t-\r ]+[0-9A-Za-z_.$]+:', 1), ''),
  regexp_extract(text, '(?i)(?:^|[^\p{L}\p{N}_])(TRACE|DEBUG|INFO|NOTICE|WARN(?:ING)?|ERR(?:OR)?|CRIT(?:ICAL)?|ALERT|EMERG(?:ENCY)?|FATAL)(?:$|[^\p{L}\p{N}_])', 1))) AS w FROM documents)
SELECT doc_id, CASE WHEN w IN ('trace', 'debug', 'd', 'v') THEN 'debug' WHEN w IN ('info', 'notice', 'i') THEN 'info' WHEN w IN ('warn', 'warning', 'w') THEN 'warning' WHEN w IN ('err', 'error', 'e') THEN 'error' WHEN w <> '' THEN 'critical' END AS severity FROM l""")
def document_severity(spark, sf_dir):
    """Of every document, whatever its characters; a null text has no severity."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", profile.extract_severity(F.col("text")).alias("severity"))


@query("process_tag", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'sshd' WHEN 1 THEN 'su' END AS process, CASE WHEN event_id % 3 < 2 THEN CAST(event_id AS VARCHAR) END AS pid FROM events")
def process_tag(spark, sf_dir):
    name, pid = profile.extract_process(F.expr("CASE event_id % 3 WHEN 0 THEN concat('x sshd[', event_id, ']: hi') WHEN 1 THEN concat('su(pam_unix)[', event_id, ']: hi') ELSE 'no [1] tag' END"))
    return base(spark, sf_dir).select("event_id", name.alias("process"), pid.alias("pid"))


@query("host_after_bsd", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'web-' || user_id END AS host FROM events")
def host_after_bsd(spark, sf_dir):
    text = f"CASE event_id % 3 WHEN 0 THEN concat({_MONTH}, ' 14 15:16:01 web-', user_id, ' sshd[1]: x') WHEN 1 THEN concat({_MONTH}, ' 14 15:16:01 sshd[1]: x') ELSE concat(at, ' web-1 x') END"
    return base(spark, sf_dir).select("event_id", profile.extract_host(F.expr(text)).alias("host"))


@query("timestamp_scan", f"{SQL_BASE} SELECT event_id, CASE event_id % 4 WHEN 0 THEN e.at || ',5' WHEN 1 THEN '2005.06.03' WHEN 2 THEN '1077804742' END AS stamp FROM e")
def timestamp_scan(spark, sf_dir):
    text = "CASE event_id % 4 WHEN 0 THEN concat('x ', at, ',5 2005.06.03') WHEN 1 THEN concat('- 2005.06.03 R02 ', replace(at, ' ', '-')) WHEN 2 THEN '134681 node-246 1077804742 1' ELSE concat(repeat('x', 80), at) END"
    return base(spark, sf_dir).select("event_id", profile.extract_timestamp(F.expr(text)).alias("stamp"))


TOKENS = {"ip_port_flow": "concat(src_ip, ':', src_port, '->', dst_ip, ':', dst_port)", "ip_port": "concat(src_ip, ':', src_port)", "ip": "src_ip", "mac": "'0a:1b:2c:3d:4e:5f'", "uuid": "'123e4567-e89b-12d3-a456-426614174000'", "email": "concat('u', user_id, '@a-b.org')", "url": "concat('http://a/', event_id)", "path": "concat('/var/log/', event_id)", "hex": "concat('0x', lower(hex(event_id)))", "date": "substring(at, 1, 10)", "time": "substring(at, 12, 8)", "ipv6": "'fe80::1:2'", "port_or_number": "cast(1 + event_id % 65535 AS string)", "large_number": "concat('7', event_id + 100000)", "unknown": "concat('w', event_id)"}


@query("token_tags", "SELECT event_id, CASE event_id % 15 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TOKENS)) + " END AS tag FROM events")
def token_tags(spark, sf_dir):
    text = "CASE event_id % 15 " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(TOKENS.values())) + " END"
    return base(spark, sf_dir).select("event_id", tags.guess_tag(F.expr(text)).alias("tag"))


# --- whole runs over several files, and aggregates ----------------------------------------------

_SHAPES = list(LINES)
_DEALT = "\nUNION ALL ".join(expected(s, "event_id // 6 + 1", f"event_id % 6 = {i}") for i, s in enumerate(_SHAPES))
SQL_MIXED = f"{SQL_BASE},\nev AS ({_DEALT})"


def mixed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of six files whose formats are found from their lines."""
    return structured_events(parsed_lines(mixed_lines(spark, sf_dir), shapes=list(LINES)), shapes=list(LINES))


@query("mixed_events", f"{SQL_MIXED} SELECT * FROM ev")
def mixed_event_columns(spark, sf_dir):
    return event_columns(mixed_events(spark, sf_dir))


# Of each file but the table, whose parser takes any line, every seventh event from the 51st line on is one that its parser rejects.
_REJECTED = "(event_id >= 300 AND event_id % 7 = 3 AND event_id % 6 <> 5)"
_TAKEN = " UNION ALL ".join(f"SELECT '{s}' AS source_name, * FROM ({expected(s, 'event_id // 6 + 1', f'event_id % 6 = {i} AND NOT {_REJECTED}')})" for i, s in enumerate(_SHAPES))


@query("mixed_events_rejected", f"""{SQL_BASE},
ev AS ({_TAKEN})
SELECT source_name, line_number, source_format, event_type, action, src_ip, message, confidence FROM ev
UNION ALL SELECT {_pick('event_id % 6', *(f"'{s}'" for s in _SHAPES))}, event_id // 6 + 1, 'unknown', 'traffic', 'other', src_ip, 'session opened for user <*> by root from <*>', CAST(0.4 AS DOUBLE) FROM e WHERE {_REJECTED}""")
def mixed_events_rejected(spark, sf_dir):
    """Six files of known shape with lines that their parsers reject: those go by template, none is lost."""
    number = F.expr("(line_number - CASE source_name WHEN 'csv' THEN 2 ELSE 1 END) * 6 + CASE source_name " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(_SHAPES)) + " END")
    rejected = base(spark, sf_dir).filter(_REJECTED).selectExpr("event_id", f"{SENTENCES[0]} AS other")
    rows = mixed_lines(spark, sf_dir).withColumn("event_id", number).join(rejected, "event_id", "left").withColumn("raw", F.coalesce("other", "raw")).drop("event_id", "other")
    found = events(rows, F.to_timestamp(F.lit(NOW)))
    return found.select("lineage.source_name", "lineage.line_number", "source_format", "event_type", "action", "src_ip", "message", "confidence")


@query("kv_summary", f"{SQL_BASE} SELECT action, 'kv_syslog' AS source_format, count(*) AS events, CAST(0.95 AS DOUBLE) AS avg_confidence FROM e GROUP BY action")
def kv_summary(spark, sf_dir):
    found = structured_events(parsed_lines(lines(spark, sf_dir, "kv_syslog"), shapes=["kv_syslog"]), shapes=["kv_syslog"])
    return found.groupBy("action", "source_format").agg(F.count("*").alias("events"), (F.sum(F.round(F.col("confidence") * 100).cast("bigint")) / F.count("*") / 100).alias("avg_confidence"))


for _column in ("action", "source_format", "vendor"):
    @query(f"count_by_{_column.removeprefix('source_')}", f"{SQL_MIXED} SELECT {_column}, count(*) AS events FROM ev GROUP BY ALL")
    def count_by(spark, sf_dir, column=_column):
        return summary.count_by(mixed_events(spark, sf_dir), column)

_FIRST = ", first AS (SELECT *, CASE source_format " + " ".join(f"WHEN '{s}' THEN '/logs/{s}.log'" for s in _SHAPES) + " END AS path FROM ev)"


@query("top_src_ip", f"{SQL_MIXED}{_FIRST} SELECT src_ip, events FROM (SELECT src_ip, count(*) AS events, min((path, line_number)) AS f FROM first GROUP BY src_ip) ORDER BY events DESC, f LIMIT 8")
def top_src_ip(spark, sf_dir):
    return summary.top(mixed_events(spark, sf_dir), "src_ip")


@query("action_shares", f"{SQL_MIXED} SELECT action, count(*) AS events, 100 * count(*) / (SELECT count(*) FROM ev) AS pct_of_all, 100 * count(*) / (SELECT count(*) FROM ev) AS pct_of_shown FROM ev GROUP BY action")
def action_shares(spark, sf_dir):
    return summary.shares(mixed_events(spark, sf_dir), "action")


@query("conf_hist", f"{SQL_MIXED} SELECT 'high' AS bucket, count(*) AS events FROM ev")
def conf_hist(spark, sf_dir):
    return summary.confidence_histogram(mixed_events(spark, sf_dir))


@query("events_by_year", "SELECT strftime(ts, '%Y') AS year, count(*) AS events FROM events GROUP BY ALL")
def events_by_year(spark, sf_dir):
    return summary.by_year(mixed_events(spark, sf_dir))


@query("totals", f"""{SQL_MIXED} SELECT count(*) AS events, count(*) FILTER (action = 'deny') AS denied, 100.0 * count(*) FILTER (action = 'deny') / count(*) AS deny_rate,
count(DISTINCT src_ip) AS src_ips, count(DISTINCT vendor) AS vendors, count(DISTINCT source_format) AS formats, count(DISTINCT substr("timestamp", 1, 4)) AS years FROM ev""")
def totals(spark, sf_dir):
    return summary.totals(mixed_events(spark, sf_dir)).drop("avg_confidence")


@query("counters", f"""{SQL_MIXED} SELECT 'action' AS counter, action AS value, count(*) AS events FROM ev GROUP BY ALL UNION ALL SELECT 'source_format', source_format, count(*) FROM ev GROUP BY ALL
UNION ALL SELECT 'vendor', vendor, count(*) FROM ev GROUP BY ALL UNION ALL SELECT 'src_ip', src_ip, count(*) FROM ev GROUP BY ALL UNION ALL SELECT 'bucket', 'high', count(*) FROM ev UNION ALL SELECT 'year', substr("timestamp", 1, 4), count(*) FROM ev GROUP BY ALL""")
def counters(spark, sf_dir):
    return summary.counters(mixed_events(spark, sf_dir))


@query("sample_first_25", f"{SQL_MIXED}{_FIRST} SELECT path AS source_path, line_number, action, src_ip FROM first ORDER BY path, line_number LIMIT 25")
def sample_first_25(spark, sf_dir):
    return summary.sample(mixed_events(spark, sf_dir)).select("lineage.source_path", "lineage.line_number", "action", "src_ip")


@query("per_source_report", f"{SQL_MIXED}{_FIRST} SELECT path AS source_path, source_format AS source_name, count(*) AS events, CAST(min(confidence) AS DOUBLE) AS avg_confidence, count(*) AS high, CAST(0 AS BIGINT) AS medium, CAST(0 AS BIGINT) AS low FROM first GROUP BY ALL")
def per_source_report(spark, sf_dir):
    return summary.per_source(mixed_events(spark, sf_dir)).drop("first_event_id")


@query("event_search", f"{SQL_MIXED} SELECT source_format, line_number FROM ev WHERE contains(lower(concat_ws(' ', \"timestamp\", vendor, source_format, action, src_ip, dst_ip, CAST(confidence AS VARCHAR))), '10.0.0.7 192')")
def event_search(spark, sf_dir):
    return summary.search(mixed_events(spark, sf_dir).withColumn("confidence", F.col("confidence")), "10.0.0.7 192").select("source_format", "lineage.line_number")


# --- templates ----------------------------------------------------------------------------------

SENTENCES = ["concat('session opened for user u', user_id, ' by root from ', src_ip)", "concat('interface eth', event_id % 4, ' dropped ', packets, ' packets today at gate')", "concat('cache flush finished | took ', event_id, ',ms')"]
_SENTENCE = "CASE event_id % 3 " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(SENTENCES)) + " END"
_TEMPLATE = "CASE event_id % 3 WHEN 0 THEN 'session opened for user <*> by root from <*>' WHEN 1 THEN 'interface <*> dropped <*> packets today at gate' ELSE 'cache flush finished took <*> ms' END"


def free_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir).selectExpr("concat('/logs/app', event_id % 2, '.log') AS source_path", "concat('app', event_id % 2) AS source_name", "event_id + 1 AS line_number", f"{_SENTENCE} AS raw")


@query("template_mine", f"SELECT 'app' || (event_id % 2) AS source_name, {_TEMPLATE} AS template, count(*) AS size FROM events GROUP BY ALL")
def template_mine(spark, sf_dir):
    return templates.train(free_lines(spark, sf_dir)).select("source_name", "template", "size")


@query("template_match", f"{SQL_BASE} SELECT event_id + 1 AS line_number, {_TEMPLATE} AS template, CASE event_id % 3 WHEN 0 THEN 'u' || user_id || ' ' || src_ip WHEN 1 THEN 'eth' || (event_id % 4) || ' ' || packets ELSE '' || event_id END AS variables, CASE event_id % 3 WHEN 0 THEN 'unknown ip' WHEN 1 THEN 'unknown port_or_number' ELSE CASE WHEN event_id BETWEEN 1 AND 65535 THEN 'port_or_number' ELSE 'large_number' END END AS types FROM e")
def template_match(spark, sf_dir):
    rows = free_lines(spark, sf_dir)
    found = templates.match(rows, templates.train(rows))
    return found.selectExpr("line_number", "template", "array_join(transform(variables, v -> v.value), ' ') AS variables", "array_join(transform(variables, v -> v.guessed_type), ' ') AS types")


def _so_far(value: str) -> str:
    """A word as it is while it was always the same, then a variable."""
    return f"CASE WHEN min({value}) OVER w = max({value}) OVER w THEN {value} ELSE '<*>' END"


@query("template_online", f"""{SQL_BASE} SELECT event_id + 1 AS line_number, row_number() OVER w AS cluster_size, CASE event_id % 3 WHEN 0 THEN 'session opened for user ' || {_so_far("'u' || user_id")} || ' by root from ' || {_so_far("src_ip")}
  WHEN 1 THEN 'interface ' || {_so_far("'eth' || (event_id % 4)")} || ' dropped ' || {_so_far("'' || packets")} || ' packets today at gate' ELSE 'cache flush finished took ' || {_so_far("'' || event_id")} || ' ms' END AS template FROM e WINDOW w AS (PARTITION BY event_id % 6 ORDER BY event_id)""")
def template_online(spark, sf_dir):
    return templates.mine_online(free_lines(spark, sf_dir)).select("line_number", "cluster_size", "template")


@query("template_promote", f"SELECT sha1(template)[1:16] AS signature, template, count(*) AS sample_count FROM (SELECT {_TEMPLATE} AS template FROM events WHERE event_id % 2 = CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 0 ELSE 0 END) GROUP BY template HAVING count(*) >= 20")
def template_promote(spark, sf_dir):
    return templates.promote(templates.train(free_lines(spark, sf_dir))).select("signature", "template", "sample_count")


@query("codebook_match", f"SELECT event_id + 1 AS line_number, 'learned:' || sha1({_TEMPLATE})[1:16] AS cluster_id, TRUE AS learned FROM events")
def codebook_match(spark, sf_dir):
    rows = free_lines(spark, sf_dir)
    mined = templates.train(rows)
    return templates.match(rows, mined, templates.promote(mined)).select("line_number", "cluster_id", "learned")


@query("codebook_merge", f"SELECT {_TEMPLATE} AS template, count(*) AS sample_count FROM events GROUP BY ALL")
def codebook_merge(spark, sf_dir):
    return templates.merge_codebooks(*two_codebooks(spark, sf_dir)).select("template", "sample_count")


def two_codebooks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Of two sources that saw the same sentences: each misses half of one kind, so each is ahead once and they are equal once."""
    rows = free_lines(spark, sf_dir)

    def book(name: str, halved: int) -> DataFrame:
        seen = rows.filter(f"(line_number - 1) % 3 != {halved} OR line_number % 2 = 0")
        return templates.promote(templates.train(seen.withColumn("source_name", F.lit(name))))

    return book("left", 2), book("right", 0)


@query("unknown_events", f"{SQL_BASE} SELECT event_id + 1 AS line_number, CASE event_id % 3 WHEN 0 THEN 'traffic' ELSE 'unclassified' END AS event_type, CASE event_id % 3 WHEN 1 THEN 'deny' ELSE 'other' END AS action, CASE event_id % 3 WHEN 0 THEN src_ip END AS src_ip, {_TEMPLATE} AS message, CASE event_id % 3 WHEN 0 THEN 0.4 ELSE 0.3 END::DOUBLE AS confidence FROM e")
def unknown_events(spark, sf_dir):
    rows = free_lines(spark, sf_dir).withColumns({"format": F.lit("unknown"), "header": F.lit(None).cast("string")})
    # Messages alone: this year's date would hide in a number of ten digits.
    return events(rows, F.to_timestamp(F.lit(NOW))).select("lineage.line_number", "event_type", "action", "src_ip", "message", "confidence")


# --- onboarding and registry --------------------------------------------------------------------

@query("onboarding_report", "SELECT 's' || k AS source_name, format, status, needs, prefix FROM (VALUES (0, 'json', 'auto (zero-code, self-describing shape)', 'nothing', NULL), (1, 'coded_syslog', 'codebook-driven (JSON config only)', 'nothing', 'ASA'), (2, 'coded_syslog', 'codebook-driven (JSON config only)', 'codebook', 'PAN'), (3, 'unknown', 'fallback (statistical, needs review before trusting fully)', 'review of templates', NULL)) t(k, format, status, needs, prefix)")
def onboarding_report(spark, sf_dir):
    raw = f"CASE event_id % 4 WHEN 0 THEN {LINES['json']} WHEN 1 THEN concat('<1>Jan 1 2024 00:00:00 f : ', {ASA}) WHEN 2 THEN concat('<1>Jan 1 2024 00:00:00 f : %PAN-1-', 100 + event_id % 3, ': x') ELSE {SENTENCES[0]} END"
    rows = base(spark, sf_dir).selectExpr("concat('/logs/s', event_id % 4) AS source_path", "concat('s', event_id % 4) AS source_name", "event_id div 4 + 1 AS line_number", f"{raw} AS raw")
    return onboard.onboarding_report(rows).select("source_name", "format", "status", "needs", "prefix")


@query("codebook_scaffold", "SELECT CAST(100 + user_id % 7 AS VARCHAR) AS code, count(*) AS seen_count, 'x %PAN-1-' || (100 + user_id % 7) || ': event ' || min(event_id) AS example_line FROM events GROUP BY user_id % 7")
def codebook_scaffold(spark, sf_dir):
    rows = base(spark, sf_dir).selectExpr("'/logs/pan' AS source_path", "'pan' AS source_name", "event_id + 1 AS line_number", "concat(' x %PAN-1-', 100 + user_id % 7, ': event ', event_id, ' ') AS raw")
    return onboard.scaffold_codes(rows, "PAN")


@query("registry", "SELECT 'u' || (user_id % 10) AS source_name, CASE user_id % 10 WHEN 3 THEN 'unknown' ELSE 'json' END AS detected_format, count(DISTINCT user_id) * 2 AS files_processed FROM events GROUP BY user_id % 10")
def registry(spark, sf_dir):
    rows = base(spark, sf_dir).selectExpr("concat('u', user_id % 10) AS source_name", "concat('/logs/', user_id) AS source_path", "CASE user_id % 10 WHEN 3 THEN 'unknown' ELSE 'json' END AS format").distinct()
    once = onboard.register(rows, "2024-01-01T00:00:00+00:00")
    return onboard.register(rows, "2024-01-02T00:00:00+00:00", once).select("source_name", "detected_format", "files_processed")


# --- sources, sinks, streams --------------------------------------------------------------------

@query("read_lines", f"{SQL_BASE} SELECT count(*) AS lines, CAST(count(*) * (count(*) + 1) // 2 AS BIGINT) AS numbers, count(DISTINCT event_id) AS raws FROM e")
def read_back(spark, sf_dir):
    """Lines written to a file and read back in splits, numbered without gaps."""
    folder = shared_folder(spark)
    base(spark, sf_dir).selectExpr(f"{LINES['kv_syslog']} AS value").coalesce(1).write.text(f"{folder}/kv")
    return read_lines(spark, f"{folder}/kv").agg(F.count("*").alias("lines"), F.sum("line_number").alias("numbers"), F.countDistinct("raw").alias("raws"))


@query("read_gzip", f"{SQL_BASE} SELECT count(*) AS lines, CAST(count(*) * (count(*) + 1) // 2 AS BIGINT) AS numbers, count(DISTINCT event_id) AS raws FROM e")
def read_gzip(spark, sf_dir):
    folder = shared_folder(spark)
    base(spark, sf_dir).selectExpr(f"{LINES['json']} AS value").coalesce(1).write.option("compression", "gzip").text(f"{folder}/json")
    return read_lines(spark, f"{folder}/json").agg(F.count("*").alias("lines"), F.sum("line_number").alias("numbers"), F.countDistinct("raw").alias("raws"))


@query("flatten_lineage", f"{SQL_MIXED}{_FIRST} SELECT path AS lineage_source_path, source_format AS lineage_source_name, line_number AS lineage_line_number, action, bytes_sent FROM first")
def flatten_lineage(spark, sf_dir):
    return sinks.flatten(mixed_events(spark, sf_dir)).select("lineage_source_path", "lineage_source_name", "lineage_line_number", "action", "bytes_sent")


@query("bulk_ndjson", f"{SQL_BASE} SELECT 'shapelog-events' AS idx, TRUE AS same_id, action, iso AS stamp, 24 AS keys FROM e")
def bulk_ndjson(spark, sf_dir):
    found = sinks.bulk_ndjson(structured_events(parsed_lines(lines(spark, sf_dir, "kv_syslog"), shapes=["kv_syslog"]), shapes=["kv_syslog"]))
    doc = F.element_at(F.split("value", "\n"), 2)
    action = F.element_at(F.split("value", "\n"), 1)
    return found.select(
        F.get_json_object(action, "$.index._index").alias("idx"), (F.get_json_object(action, "$.index._id") == F.get_json_object(doc, "$.event_id")).alias("same_id"),
        F.get_json_object(doc, "$.action").alias("action"), F.get_json_object(doc, "$['@timestamp']").alias("stamp"), F.size(F.json_object_keys(doc)).alias("keys"),
    )


@query("sql_functions", f"{SQL_BASE} SELECT event_id, action, protocol, src_port AS port, src_ip AS ip FROM e")
def sql_functions_query(spark, sf_dir):
    sql_functions.register(spark)
    return base(spark, sf_dir).selectExpr("event_id", "log_action(word) AS action", "log_protocol(proto) AS protocol", "log_int(concat(' ', src_port)) AS port", "get(log_ipv4s(concat('a ', src_ip)), 0) AS ip")


@query("stream_events", f"{SQL_BASE} SELECT action, count(*) AS events, CAST(sum(event_id + 1) AS BIGINT) AS numbers FROM e GROUP BY action")
def streamed(spark, sf_dir):
    """The same events by a stream of files as by a batch."""
    folder = shared_folder(spark)
    base(spark, sf_dir).repartition(1).sortWithinPartitions("event_id").selectExpr(f"{LINES['kv_syslog']} AS value").write.text(f"{folder}/in")
    started = stream_events(spark, f"{folder}/in", f"{folder}/out", f"{folder}/state")
    started.awaitTermination()
    return spark.read.parquet(f"{folder}/out").groupBy("action").agg(F.count("*").alias("events"), F.sum("lineage_line_number").alias("numbers"))


from shapelog.plans import field_queries  # noqa: E402  registers its queries here

__all__ = ["field_queries", "COLUMNS", "EXPECTED", "ORACLE_SQL", "QUERIES"]

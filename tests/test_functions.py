"""Parsers and column functions on hand-written lines."""

import gzip

from pyspark.sql import functions as F

from shapelog.functions import parse, profile, scalars, sniff, tags
from shapelog.functions.timestamps import normalize_timestamp
from shapelog.operators import onboard, templates
from shapelog.operators.events import events
from shapelog.sources import sinks
from shapelog.sources.lines import read_lines

SAMPLE = [
    "2026-09-01|10:15:22|DENY|10.10.10.5|52344|93.184.216.34|443|TCP|BlockedByRule12", "2026-09-01|10:16:47|ALLOW|10.10.10.8|41220|8.8.8.8|53|UDP|BlockedByRule4",
    "2026-09-01|10:18:03|DENY|198.51.100.14|33210|10.10.10.20|3389|TCP|BlockedByRule12", "2026-09-01|10:19:55|ALLOW|10.10.10.12|55210|172.217.0.10|443|TCP|BlockedByRule1",
    "2026-09-01|10:21:10|DENY|203.0.113.7|21987|10.10.10.5|22|TCP|BlockedByRule12", "2026-09-01|10:22:44|ALLOW|10.10.10.9|60112|8.8.4.4|53|UDP|BlockedByRule4",
    "2026-09-01|10:24:19|DENY|198.51.100.90|48211|10.10.10.30|445|TCP|BlockedByRule9", "2026-09-01|10:26:02|ALLOW|10.10.10.15|51890|93.184.216.34|443|TCP|BlockedByRule1",
]


def one(spark, function, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.x for r in rows.select("i", function(F.col("t")).alias("x")).orderBy("i").collect()]


def test_timestamps(spark):
    now = lambda c: normalize_timestamp(c, F.to_timestamp(F.lit("2025-01-02 00:00:00")))
    got = one(spark, now, "2024-02-29 01:02:03,1234", "2023-02-29 00:00:00", "2024-01-01 00:00:60", "2024-01-01T00:00:00+05:30", "Jan  3 04:05:06", "Jan 2 04:05:06", "Feb 29 00:00:00", "[10.30 16:49:06]", "1077804742", "", None)
    assert got == ["2024-02-29T01:02:03.123Z", None, None, "2024-01-01T00:00:00.000Z", "2024-01-03T04:05:06.000Z", "2025-01-02T04:05:06.000Z", None, "2024-10-30T16:49:06.000Z", "2004-02-26T14:12:22.000Z", None, None]


def test_sniff(spark):
    got = one(spark, sniff.sniff_line, '{"a":1} x', '{"a":1}', "a=1 b=2 c=3 in a long sentence of many words", "a=1 b=2 c=3 d=4 e", "x, y, z", "  ", "x CEF:0|a", "[1]", "<1>1 a b c d e - x")
    assert got == ["unknown", "json", "unknown", "kv_syslog", "csv_like", "empty", "cef", "unknown", "syslog5424"]


def test_parsers(spark):
    assert one(spark, parse.parse_kv, 'a=1 a=2 b="x y"', "none") == [{"a": "2", "b": "x y"}, None]
    cef = one(spark, parse.parse_cef, "h CEF:0|V|P|1|2|N|3|vendor=over msg=a b=c")[0]
    assert (cef["vendor"], cef["msg"], cef["b"], cef["syslog_prefix"]) == ("over", "a", "c", "h")
    leef = one(spark, parse.parse_leef, "LEEF:1.0|V|P|1|E|a=1\tb=2 3", "LEEF:2.0|V|P|1|E|x5e|a=1^b=2", "LEEF:2.0|V|P|1|E||a=1\tb=2", "LEEF:2.0|V|P|1|E|longer|a=1")
    assert [(x["a"], x.get("b")) for x in leef] == [("1", "2 3"), ("1", "2"), ("1", "2"), ("1", None)]
    rfc = one(spark, parse.parse_rfc5424, '<1>1 t h a p m - hello', '<1>1 t h a p m [x k="1"] [y l="2"] hi', '<1>1 t h a p m [x k="1"][y l="2"] hi', '<1>1 t h a p m [x k="1"')
    assert [(x["message"], x["has_structured_data"], x.get("k"), x.get("l")) for x in rfc] == [("hello", "false", None, None), ("hi", "true", "1", "2"), ('[y l="2"] hi', "true", "1", None), ("", "true", None, None)]
    coded = one(spark, parse.parse_coded, "<1>Jan 1 2024 00:00:00 h : %XYZ-1-9: x", "<1>Jan 1 00:00:00 h : %ASA-1-9: x")
    assert coded[0]["vendor"] == "xyz" and coded[0]["matched_code"] == "false" and coded[1] is None
    assert one(spark, lambda c: parse.parse_csv(F.lit("a,b,c"), c), '1,"x, ""y""",3', "1") == [{"a": "1", "b": 'x, "y"', "c": "3"}, {"a": "1", "b": None, "c": None}]


def test_scalars(spark):
    assert one(spark, scalars.to_int, " 12\t", "-3", "1.5", "", None) == [12, -3, None, None, None]
    assert one(spark, scalars.normalize_action, " DENY ", "blocked", "what", None) == ["deny", "deny", "other", "other"]
    assert one(spark, scalars.normalize_protocol, "6", " GRE", None) == ["tcp", "gre", None]
    assert one(spark, profile.extract_timestamp, "x 2005-06-03-15.42.50.675872 2005.06.03", "no") == ["2005-06-03-15.42.50.675872", None]
    assert one(spark, tags.guess_tag, "1.2.3.4:80->5.6.7.8:9", "70000", "0", "") == ["ip_port_flow", "large_number", "large_number", "unknown"]


def sample(spark):
    rows = [("/logs/06.log", "06", i + 1, x) for i, x in enumerate(SAMPLE)]
    return spark.createDataFrame(rows, "source_path string, source_name string, line_number bigint, raw string")


def test_sample_of_unknown_shape(spark):
    got = {r.lineage.line_number: r for r in events(sample(spark)).collect()}
    want = {1: ("deny", "10.10.10.5", 52344, "93.184.216.34", 443, 0.45), 2: ("allow", "10.10.10.8", 41220, "8.8.8.8", None, 0.45), 7: ("deny", "198.51.100.90", None, "10.10.10.30", None, 0.4)}
    for n, w in want.items():
        r = got[n]
        assert (r.action, r.src_ip, r.src_port, r.dst_ip, r.dst_port, r.confidence) == w
    assert len(got) == 8 and {r.source_format for r in got.values()} == {"unknown"} and all(r.timestamp is None for r in got.values())
    online = {r.lineage.line_number: r.confidence for r in events(sample(spark), mode="online").collect()}
    assert online == {1: 0.4, 2: 0.4, 3: 0.45, 4: 0.4, 5: 0.45, 6: 0.45, 7: 0.4, 8: 0.45}


def test_codebook_round_trip(spark, tmp_path):
    mined = templates.train(sample(spark))
    book = templates.promote(mined, 2)
    assert templates.save_codebook(book, str(tmp_path / "book.json")) == 3
    again = templates.load_codebook(spark, str(tmp_path / "book.json"))
    hits = templates.match(sample(spark), mined.limit(0), again).filter("learned").count()
    assert hits == 7
    assert templates.promote(mined, 2, again).count() == 0
    assert templates.train(sample(spark), salts=2).agg(F.sum("size")).first()[0] == 8


def test_files(spark, tmp_path):
    text = "a=1 b=2 c=3\r\n\nd=4 e=5 f=6\n"
    (tmp_path / "plain.log").write_bytes(text.encode() + b"g=\xff h=1 i=2\n")
    (tmp_path / "misnamed.log").write_bytes(gzip.compress(text.encode()))
    with gzip.open(tmp_path / "named.log.gz", "wt") as f:
        f.write(text)
    (tmp_path / "empty.log").write_bytes(b"")
    got = {(r.source_name, r.line_number): r.raw for r in read_lines(spark, str(tmp_path)).collect()}
    assert got["plain", 3] == got["misnamed", 3] == got["named.log", 3] == "d=4 e=5 f=6"
    assert got["plain", 2] == got["misnamed", 2] == "" and "�" in got["plain", 4]
    found = events(read_lines(spark, str(tmp_path)))
    assert found.count() == 7 and {r.source_format for r in found.select("source_format").collect()} == {"kv_syslog"}


def test_splits_do_not_change_numbers(spark, tmp_path):
    (tmp_path / "big.log").write_text("".join(f"k={i} l={i} m={i}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        rows = read_lines(spark, str(tmp_path / "big.log")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.line_number, r.raw) for r in rows) == [(i + 1, f"k={i} l={i} m={i}") for i in range(5000)]


def test_sinks_and_onboarding(spark, tmp_path):
    found = events(sample(spark))
    sinks.write_all(found, str(tmp_path / "out"))
    assert len(spark.read.parquet(str(tmp_path / "out/events.parquet")).columns) == 27
    assert spark.read.text(str(tmp_path / "out/bulk.ndjson")).count() == 16
    page = sinks.write_dashboard(found, str(tmp_path / "page.html"))
    assert "198.51.100.90" in open(page).read()
    assert sinks.index_mapping()["mappings"]["properties"]["src_ip"] == {"type": "ip"}
    report = onboard.onboarding_report(sample(spark)).first()
    assert (report.format, report.needs, report.lines) == ("unknown", "review of templates", 8)
    seen = spark.createDataFrame([("a", "/a/1", "json"), ("a", "/a/2", "cef")], "source_name string, source_path string, format string")
    onboard.save_registry(onboard.register(seen, "2024"), str(tmp_path / "reg.json"))
    state = onboard.load_registry(spark, str(tmp_path / "reg.json")).first()
    assert (state.files_processed, state.detected_format, state.last_file) == (2, "cef", "/a/2")


def test_misnamed_gzip_of_members_and_sizes(spark, tmp_path, monkeypatch):
    """Members one after another, lines over their edges, much data from few bytes, no newline at the end."""
    text = "".join(f"a={i} b=é c={i * i}\n" for i in range(30_000))
    data = text.encode()
    (tmp_path / "members.log").write_bytes(gzip.compress(data[:1000]) + gzip.compress(data[1000:2500]) + gzip.compress(data[2500:]))
    (tmp_path / "repeated.log").write_bytes(gzip.compress(b"x" * 9_000_000 + b"\nlast"))
    (tmp_path / "plain.log").write_text("one\n\ntwo")
    rows = read_lines(spark, str(tmp_path)).collect()
    found = {}
    for r in rows:
        found.setdefault(r.source_name, []).append((r.line_number, r.raw))
    assert sorted(found["members"]) == list(enumerate(text.splitlines(), 1))
    assert [(n, len(x)) for n, x in sorted(found["repeated"])] == [(1, 9_000_000), (2, 4)]
    assert sorted(found["plain"]) == [(1, "one"), (2, ""), (3, "two")]


def test_numbering_shuffles_no_line(spark, tmp_path):
    (tmp_path / "some.log").write_text("x\n" * 100)
    plan = read_lines(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan.split("InMemoryTableScan")[0]

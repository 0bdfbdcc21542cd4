"""Column functions give the same values among stages, as lambdas and as SQL functions, and all of them what plain Python gives."""

import random
import re

from pyspark.sql import functions as F

from shapelog.functions import parse, profile, sniff, tags
from shapelog.functions import sql as sql_functions
from shapelog.functions.text import Stages, settled
from shapelog.functions.timestamps import normalize_timestamp

PIECES = ["CEF:0|V|P|1|2|N|3|", "LEEF:2.0|V|P|1|E|^|", "LEEF:1.0|V|P|1|E|", "<1>1 t h a p m ", "<1>Jan 1 2024 00:00:00 h : ", "%ASA-4-106023: Deny tcp src a:1.2.3.4/5 dst b:6.7.8.9/10 by access-group \"x\"", "a=1", " a=2", "b=\"x y\"", "c=", "^d=4", "\te=5", "[x k=\"v\"]", " [y l=\"w\"]", "- ", "\"", "\\E", "|", " ", "=", "é=ü ", "f=g=h", "{\"a\": 1}", "2024-01-02 03:04:05,6", "Jan  2 03:04:05", "x[12]:", "10.0.0.1:80"]


def lines(n=150):
    r = random.Random(7)
    return ["".join(r.choice(PIECES) for _ in range(r.randrange(1, 7))) for _ in range(n)]


def pairs(text):
    """Keys and values up to the next key, by plain Python."""
    found = list(re.finditer(r"(\w+)=", text))
    return {m[1]: text[m.end() : (found[i + 1].start() if i + 1 < len(found) else len(text))].strip() for i, m in enumerate(found)}


def test_stages_lambdas_and_sql_agree(spark):
    now = F.to_timestamp(F.lit("2024-06-30 12:00:00"))
    made = {
        "kv": parse.parse_kv, "cef": parse.parse_cef, "leef": parse.parse_leef, "rfc": parse.parse_rfc5424, "coded": parse.parse_coded, "json": parse.parse_json,
        "stamp": lambda x: normalize_timestamp(profile.extract_timestamp(x), now), "profile": profile.profile_line, "tag": tags.tag_variable, "sniff": sniff.sniff_line,
    }
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines())] + [(-1, None), (-2, "")], "i int, x string")
    plain = {r.i: r for r in rows.select("i", *(f(F.col("x")).alias(k) for k, f in made.items())).collect()}
    stages = Stages()
    with stages:
        columns = {k: f(F.col("x")) for k, f in made.items()}
    staged = {r.i: r for r in settled(stages.add(rows, **columns)).drop("x").collect()}
    assert [staged[i][k] for i in plain for k in made] == [plain[i][k] for i in plain for k in made]
    assert sum(r.cef is not None for r in plain.values()) > 3 and sum(r.leef is not None for r in plain.values()) > 3 and sum(r.rfc is not None for r in plain.values()) > 3
    sql_functions.register(spark)
    rows.createOrReplaceTempView("stage_lines")
    by_sql = {r.i: r for r in spark.sql("SELECT i, log_parse_kv(x) AS kv, log_parse_cef(x) AS cef, log_parse_leef(x) AS leef, log_parse_rfc5424(x) AS rfc, log_parse_coded(x) AS coded, log_parse_json(x) AS json, log_profile(x) AS profile, log_tag(x) AS tag, log_sniff(x) AS sniff FROM stage_lines").collect()}
    assert [by_sql[i][k] for i in plain for k in made if k != "stamp"] == [plain[i][k] for i in plain for k in made if k != "stamp"]


def test_cef_by_plain_python(spark):
    texts = [x for x in lines(400) if re.search(r"CEF:\d+\|([^|]*\|){6}", x)]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    found = {r.i: r.f for r in rows.select("i", parse.parse_cef(F.col("x")).alias("f")).collect()}
    for i, x in enumerate(texts):
        before, _, rest = x.partition("CEF:")
        m = re.search(r"CEF:(\d+)\|" + r"([^|]*)\|" * 6 + "(.*)$", "CEF:" + rest)
        names = ["cef_version", "vendor", "product", "product_version", "signature_id", "name", "severity"]
        assert found[i] == dict(zip(names, m.groups(), strict=False)) | pairs(m[8]) | {"syslog_prefix": before.strip()}, x

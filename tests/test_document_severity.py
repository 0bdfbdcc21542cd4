"""Severity of every document: accented and other scripts, nulls and repeated rows, against brute force and SQL."""

import re

import duckdb

from shapelog.plans.queries import ORACLE_SQL, QUERIES

TEXTS = [
    None, "", "plain text", "Éa error here", "éerror", "errorñ", "x_error", "café WARN", "中文 fatal 中文", "中fatal", "érror", "erroŕ", "²error", "٣ info", "error", "error",
    "17 23 D Tag: error", "é17 23 D Tag: x", "é 17  23\tF a.b$c: x", "17 23 W Täg: x", "Notice", "warnings then WARNING", "terror error\nû",
]
KNOWN = {"trace": "debug", "d": "debug", "v": "debug", "notice": "info", "i": "info", "warn": "warning", "w": "warning", "err": "error", "e": "error"} | {x: x for x in ("debug", "info", "warning", "error")}


def severity(text):
    letter = re.search(r"\b[0-9]+[ \t-\r]+[0-9]+[ \t-\r]+([VDIWEF])[ \t-\r]+[0-9A-Za-z_.$]+:", text or "")
    found = letter or re.search(r"\b(TRACE|DEBUG|INFO|NOTICE|WARN(?:ING)?|ERR(?:OR)?|CRIT(?:ICAL)?|ALERT|EMERG(?:ENCY)?|FATAL)\b", text or "", re.I)
    return found and KNOWN.get(found[1].lower(), "critical")


def test_document_severity(spark, tmp_path):
    docs = [*enumerate(TEXTS), (None, "é alert"), (3, "Éa error here")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted(((i, severity(t)) for i, t in docs), key=repr)
    assert sorted(map(tuple, QUERIES["document_severity"](spark, str(tmp_path)).collect()), key=repr) == want
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.sql(ORACLE_SQL["document_severity"]).fetchall(), key=repr) == want


def test_every_document_has_a_row(spark):
    con, data = duckdb.connect(), "/root/testdata/sf0.01"
    con.sql(f"create view documents as select * from '{data}/documents.parquet'")
    found = list(map(tuple, QUERIES["document_severity"](spark, data).collect()))
    assert len(found) == con.sql("select count(*) from documents").fetchall()[0][0]
    assert sorted(found, key=repr) == sorted(con.sql(ORACLE_SQL["document_severity"]).fetchall(), key=repr)

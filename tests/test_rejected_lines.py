"""Lines that the parser of their file's shape rejects go by template."""

import duckdb

from shapelog.plans.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


def test_mixed_events_rejected(spark):
    con = duckdb.connect()
    con.sql(f"create view events as select * from '{DATA}/events.parquet'")
    found, want = QUERIES["mixed_events_rejected"](spark, DATA), con.sql(ORACLE_SQL["mixed_events_rejected"])
    assert found.columns == want.columns
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == sorted(want.fetchall(), key=repr) and len(got) == 1000 and {r[0] for r in got if r[2] == "unknown"} == {"json", "kv_syslog", "cef", "leef", "syslog5424"}

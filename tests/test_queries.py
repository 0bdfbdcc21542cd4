"""Each engine query against its SQL, over the smallest tables."""

import duckdb
import pytest

from shapelog.plans.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
#: One of each kind; the driver compares all of them.
CHOSEN = ["cef_events", "leef_events", "coded_asa", "sniff_lines", "sniff_files", "event_id", "ts_iso", "ts_bsd_noyear", "ts_invalid", "token_tags", "counters", "template_match", "unknown_events", "read_lines", "stream_events", "registry", "unknown_fields", "console_report", "blank_lines", "sql_parsers", "template_online", "codebook_saved", "read_misnamed_gzip", "read_folder", "flatten_all", "jsonl_events", "dashboard_numbers", "stream_windows"]


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in ("events", "documents"):
        con.sql(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


def rows(names, found):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([r[i] for i in order]) for r in found)


@pytest.mark.parametrize("name", CHOSEN)
def test_query(spark, tables, name):
    got = QUERIES[name](spark, DATA)
    want = tables.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, map(tuple, got.collect())) == rows(want.columns, want.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)

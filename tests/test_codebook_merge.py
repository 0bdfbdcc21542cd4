"""Codebooks of two sources, where either side can be ahead."""

import duckdb

from shapelog.operators import templates
from shapelog.plans.queries import ORACLE_SQL, QUERIES, two_codebooks

DATA = "/root/testdata/sf0.001"


def test_either_side_wins(spark):
    left, right = ({r.template: r for r in x.collect()} for x in two_codebooks(spark, DATA))
    ahead = {t: left[t].sample_count - right[t].sample_count for t in left}
    assert left.keys() == right.keys() and sorted((n > 0) - (n < 0) for n in ahead.values()) == [-1, 0, 1]
    merged = {r.template: r for r in templates.merge_codebooks(*two_codebooks(spark, DATA)).collect()}
    assert merged == {t: left[t] if ahead[t] >= 0 else right[t] for t in left}


def test_codebook_merge(spark):
    con = duckdb.connect()
    con.sql(f"create view events as select * from '{DATA}/events.parquet'")
    assert sorted(map(tuple, QUERIES["codebook_merge"](spark, DATA).collect())) == sorted(con.sql(ORACLE_SQL["codebook_merge"]).fetchall())

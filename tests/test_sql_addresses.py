"""The query over SQL functions, on a table whose user ids give texts that are no addresses."""

from shapelog.plans.queries import QUERIES


def test_no_address_is_null(spark, tmp_path):
    spark.sql("SELECT id AS event_id, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts, id * 65535 AS user_id, 'view' AS event_type, 1.0D AS value FROM range(3)").write.parquet(str(tmp_path / "events.parquet"))
    got = {r.event_id: r.ip for r in QUERIES["sql_functions"](spark, str(tmp_path)).collect()}
    assert got == {0: "10.0.0.0", 1: "10.0.255.255", 2: None}

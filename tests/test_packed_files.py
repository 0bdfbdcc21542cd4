"""Packed files of many lines: one task unpacks them, all tasks go on with their lines."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from shapelog.operators.formats import file_formats
from shapelog.sources.lines import read_lines


@pytest.fixture(scope="module")
def text():
    return [f"n={i} text={hashlib.shake_256(str(i).encode()).digest(300).hex(' ', 4)}" for i in range(1, 15001)]


@pytest.mark.parametrize("name", ["packed.log.gz", "packed.log"])
def test_lines_of_a_packed_file_are_dealt_out(spark, tmp_path, text, name):
    (tmp_path / name).write_bytes(gzip.compress("\n".join(text).encode(), 1))
    (tmp_path / "small.log.gz").write_bytes(gzip.compress(b"n=1 text=a\n\nn=3 text=b"))
    lines = read_lines(spark, str(tmp_path))
    got = lines.withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r.line_number, r.raw) for r in got if r.source_name.startswith("packed")) == list(enumerate(text, 1))
    assert sorted((r.line_number, r.raw) for r in got if r.source_name == "small.log") == [(1, "n=1 text=a"), (2, ""), (3, "n=3 text=b")]
    assert {r.source_path: r.source_name for r in got} == {str(tmp_path / name): "packed.log" if name.endswith("gz") else "packed", str(tmp_path / "small.log.gz"): "small.log"}
    assert len({r.task for r in got if r.source_name.startswith("packed")}) > 1


def test_formats_look_at_the_first_lines_only(spark, tmp_path, text):
    (tmp_path / "a.log").write_text("\n".join(text))
    plan = file_formats(read_lines(spark, str(tmp_path)))._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Filter" in x and "csv_like" in x and "value#" in x for x in plan.splitlines())

"""Folders that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_made: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; of this machine only where the session names none on a local master, as in tests.

    It is removed when the driver's Python ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = f"file://{tempfile.gettempdir()}/shapelog-checkpoints"
    path = f"{root.rstrip('/')}/shapelog-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        if spark._jvm is None or spark.sparkContext._jsc is None:
            continue
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the JVM may be gone already; the folder is only scratch space
            return


#: A table is broadcast up to this many bytes, as measured.
BROADCAST_BYTES = 64 << 20


def join_small(rows: DataFrame, known: DataFrame, on: list[str], how: str = "inner", limit: int = BROADCAST_BYTES) -> DataFrame:
    """rows joined with a table that is mostly small: broadcast if its rows, as JSON, hold at most `limit` bytes, else both are shuffled.

    `known` should be a written or kept table, as it is measured first. A broadcast leaves the rows where
    they are, whatever key most of them have.
    """
    size = known.agg(F.sum(F.octet_length(F.to_json(F.struct(*known.columns))))).first()[0] or 0
    return rows.join(F.broadcast(known) if size <= limit else known.hint("merge"), on, how)


def written(rows: DataFrame, path: str) -> DataFrame:
    """The rows written to a shared folder and read back, so that what reads them twice computes them once."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _runs(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the whole tables under a folder of kept state, in order."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [x.getPath() for x in store.listStatus(where)] if store.exists(where) else []
    names = [x.getName() for x in found if store.exists(spark._jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS"))]
    return sorted(int(x.removeprefix("run=")) for x in names if x.startswith("run="))


def latest(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame | None:
    """The state that the last whole run kept (of those before a number), or None at first."""
    found = [n for n in _runs(spark, folder) if before is None or n < before]
    return spark.read.parquet(f"{folder}/run={found[-1]}") if found else None


def keep(rows: DataFrame, folder: str, number: int | None = None) -> DataFrame:
    """Write a run's state under the next number, or the given one, and read it back. What was kept before stays."""
    number = max(_runs(rows.sparkSession, folder), default=-1) + 1 if number is None else number
    return written(rows, f"{folder}/run={number}")

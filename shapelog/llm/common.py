"""Shared pieces of the training-data operators: shared work folders, table access, heavy keys."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key that holds more than one in HEAVY_SHARE rows is heavy, so at most HEAVY_SHARE keys are.
HEAVY_SHARE = 1000

_made: list[tuple[SparkSession, str]] = []
_tables: list[tuple[SparkSession, str]] = []


def work_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share.

    Only where that setting is absent on a local master, as in tests, a folder of this machine is
    used; a cluster without the setting is an error. The folder is removed when the driver's Python
    ends, since lazy results may read it until then.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.gettempdir()}/shapelog-checkpoints"
    path = f"{base.rstrip('/')}/shapelog-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def drop_at_end(spark: SparkSession, name: str) -> None:
    """Take a table of the catalog, whose data lies in a work folder, out of it with that folder."""
    _tables.append((spark, name))


@atexit.register
def _clean() -> None:
    for spark, name in _tables:
        if spark._jvm is None or spark.sparkContext._jsc is None:
            continue
        try:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        except Exception:  # the JVM may be gone already
            return
    for spark, path in _made:
        if spark._jvm is None or spark.sparkContext._jsc is None:
            continue
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the JVM may be gone already; the folder is only scratch space
            return


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so that lost executors don't recompute it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_keyed(rows: DataFrame, keyed: DataFrame, on: list[str], weight: str, how: str = "inner") -> DataFrame:
    """rows joined with `keyed`, a written table of one row per key and the number of its rows (`weight`).

    Keys of over 1/HEAVY_SHARE of the rows each are at most HEAVY_SHARE: those are broadcast, so that
    no task gets all rows of one of them; the others meet by a sort-merge join. `rows` should be a
    written table too, as it is read twice. The weight is not in the result. how: inner or left_semi.
    """
    total = keyed.agg(F.sum(weight)).first()[0] or 0
    heavy, light = (keyed.filter(F.col(weight) * HEAVY_SHARE > total).drop(weight), keyed.filter(F.col(weight) * HEAVY_SHARE <= total).drop(weight))
    few = rows.join(F.broadcast(heavy.select(on)), on, "left_anti")
    return rows.join(F.broadcast(heavy), on, how).unionByName(few.join(light.hint("merge"), on, how))


def release_memory() -> None:
    """Give memory that this process doesn't use any more back to the system: allocators keep it else, and a driver goes on for long."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def release_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of tables that are written already.

    Spark deletes them when the driver's heap no longer holds their plans, which a driver with
    little to do may not notice for long; large shuffles of one query would add up on disk.
    """
    gc.collect()
    spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

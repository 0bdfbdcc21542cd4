"""Exact dedup: a persistent digest index, bucketed and sorted by hash.

`DigestIndex` is a table of the digests seen so far. A batch of documents is reduced to one row per
digest, joined against the index by a sort-merge anti-join (the index side needs no shuffle: it is
stored in buckets of the join key), and what is new is appended.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelog.llm.common import drop_at_end, join_keyed, materialize, table, work_dir

#: Digests of one bucket of the index (some 80 MB), on average, at most: an index that outgrows it gets more buckets.
BUCKET_ROWS = 1_000_000
LEAST_BUCKETS = 8


def normalized(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    return F.sha2(normalized(text).cast("binary"), 256)


class DigestIndex:
    """(digest, keep_id) of every text seen, in buckets sorted by digest, under `location`.

    The buckets lie in a folder named after their number, which grows with the index: a larger one is
    written whole before it counts. A location that already holds an index is opened, not emptied.
    temporary: the table's name leaves the catalog when the driver's Python ends.
    """

    def __init__(self, spark: SparkSession, location: str, id_type: str = "bigint", bucket_rows: int = BUCKET_ROWS, temporary: bool = False):
        self.spark, self.location, self.id_type, self.bucket_rows, self.temporary = spark, location.rstrip("/"), id_type, bucket_rows, temporary
        self.buckets = 0
        for number in self._written():
            self._open(number)

    def _written(self) -> list[int]:
        """The number of buckets of the newest whole index, if there is one."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.location)
        store = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = [x.getPath() for x in store.listStatus(where)] if store.exists(where) else []
        whole = [x.getName() for x in found if store.exists(self.spark._jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS"))]
        return sorted(int(m[1]) for m in (re.fullmatch(r"buckets(\d+)", x) for x in whole) if m)[-1:]

    def _open(self, buckets: int) -> None:
        self.buckets = buckets
        self.name = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, self.location).hex}_{buckets}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, keep_id {self.id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.location}/buckets{buckets}'"
        )
        if self.temporary:
            drop_at_end(self.spark, self.name)

    def read(self) -> DataFrame:
        if not self.buckets:
            return self.spark.createDataFrame([], f"digest string, keep_id {self.id_type}")
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def append(self, fresh: DataFrame) -> None:
        """Add digests that the index doesn't hold; dealt by bucket first, so that each task writes one file."""
        rows, have = fresh.select("digest", "keep_id"), self.read()
        needed = LEAST_BUCKETS
        while needed * self.bucket_rows < rows.count() + have.count():
            needed *= 2
        if needed > self.buckets:
            rows = have.unionByName(rows)
            self._open(needed)
        rows.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.name)


def exact_dedup(docs: DataFrame, index: DigestIndex, folder: str) -> DataFrame:
    """Deduplicate documents against the index and each other, and append the new digests.

    Returns one row per input row: doc_id, keep_id (the row that stays: the indexed one, or the
    smallest doc_id of the batch), group_size (equal texts in this batch), kept, text_sha256.
    Null text equals the empty text. A null doc_id ranks after all others. Rows that repeat a
    doc_id with the same text are all returned alike. Other columns are ignored; an empty input
    gives an empty result and leaves the index as it is.
    """
    rows = materialize(docs.select("doc_id", digest(F.col("text")).alias("digest")), f"{folder}/digests")
    # Partial aggregation turns a group of any size into one row per map task before the shuffle.
    groups = materialize(
        rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("group_size")),
        f"{folder}/groups",
    )
    seen = index.read().select("digest").hint("merge")
    fresh = groups.select("digest", F.col("first_id").alias("keep_id")).join(seen, "digest", "left_anti")
    fresh = materialize(fresh, f"{folder}/fresh")
    if not fresh.isEmpty():
        index.append(fresh)
    found = groups.join(index.read().hint("merge"), "digest").select("digest", "keep_id", "group_size", F.col("group_size").alias("weight"))
    return join_keyed(rows, materialize(found, f"{folder}/found"), ["digest"], "weight").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), work_dir(spark)
    index = DigestIndex(spark, f"{folder}/index", dict(docs.dtypes)["doc_id"], temporary=True)
    return exact_dedup(docs, index, folder)


SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

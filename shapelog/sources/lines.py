"""Log files as a table of numbered lines."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shapelog.sources.shared import join_small

#: Bytes unpacked at once.
UNPACKED = 4 << 20
#: Lines from which a split counts as large: what is packed is one split, however large it is.
LARGE_SPLIT = 10_000
#: Lines that follow each other and stay together when a large split is dealt out.
DEALT_LINES = 64


def source_path(uri: Column) -> Column:
    """A local file's plain path; other stores keep their URI."""
    return F.regexp_replace(uri, r"^file:(//)?(?=/)", "")


def source_name(path: Column) -> Column:
    """The file's name without its last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def survey(rows: DataFrame) -> DataFrame:
    """Of each split of (uri, block, value, at) rows: its first `at`, its lines n, lines before it in the file, whether the file is gzip by its first bytes, and its path and name.

    One scan that sends a row a split; the result is kept, as it decides how the lines are read.
    """
    magic = F.substring(F.col("value").cast("binary"), 1, 2) == F.lit(bytearray(b"\x1f\x8b"))
    counts = rows.groupBy("uri", "block").agg(F.min("at").alias("start"), F.count("*").alias("n"), F.min(F.when(magic & (F.col("block") == 0), F.col("at"))).alias("magic"))
    path = source_path(F.col("uri"))
    before, whole = Window.partitionBy("uri").orderBy("block").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("uri")
    found = counts.select("uri", "block", "start", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"), F.coalesce(F.bool_or(F.col("magic") == F.col("start")).over(whole), F.lit(False)).alias("gzip"), path.alias("source_path"), source_name(path).alias("source_name"))
    return found.persist()


def numbered(rows: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """Exact line numbers of (uri, block, value) rows of files that are read in splits.

    Rows of a split come in order, so a line's number is its place after the split's first line, and the
    lines of the splits before. No line is shuffled: only a row a split is, broadcast as long as those
    rows are few. Should the files be split otherwise than when they were surveyed, an error says so.
    """
    if "at" not in rows.columns:
        rows = rows.withColumn("at", F.monotonically_increasing_id())
    splits = survey(rows) if splits is None else splits
    joined = join_small(rows, splits, ["uri", "block"], "left").filter("gzip IS NULL OR NOT gzip")
    place = F.col("at") - F.col("start")
    number = F.when(place.between(0, F.col("n") - 1), place + F.col("off") + 1).otherwise(F.raise_error(F.lit("the files are split otherwise than when they were surveyed")).cast("bigint"))
    columns = ["source_path", "source_name", number.alias("line_number"), F.make_valid_utf8("value").alias("raw")]
    # What follows costs far more than reading a line, so a packed file's lines aren't left to the one task that can read them.
    large = F.coalesce(packed(F.col("uri")) & (F.col("n") > LARGE_SPLIT), F.lit(False))
    if splits.filter(large).isEmpty():
        return joined.select(*columns)
    return joined.filter(~large).select(*columns).unionByName(dealt(joined.filter(large).select(*columns)))


def packed(uri: Column) -> Column:
    """Whether a file's extension is one of a codec that Spark's reader unpacks as one split."""
    return uri.rlike(r"\.(?:gz|deflate|lz4|snappy|zst)$")


def dealt(lines: DataFrame) -> DataFrame:
    """The lines spread over the tasks of a shuffle, by runs of a few; their numbers are theirs already."""
    return lines.repartition("source_path", F.floor(F.col("line_number") / DEALT_LINES))


def split_lines(text: DataFrame) -> DataFrame:
    """(uri, block, value) of a text source."""
    return text.select(F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("block"), "value")


def read_misnamed_gzip(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Gzip files without the extension that Spark's readers go by, unpacked as a stream.

    Their bytes come as rows of what newlines part, through the same reader as lines, so any store and any
    size works; a file's rows meet in one task, in order, as gzip can't be split. The lines are then dealt
    out, so that only unpacking is that task's work.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((path, part) for batch in batches for path, part in zip(batch["uri"].to_pylist(), batch["part"].to_pylist(), strict=True))
        for path, own in groupby(rows, key=itemgetter(0)):
            number, tail, unpack = 0, b"", zlib.decompressobj(31)
            while held := list(islice(own, 1024)):
                data = b"".join(part + b"\n" for _, part in held)
                while data:
                    tail += unpack.decompress(data, UNPACKED)
                    data = unpack.unconsumed_tail
                    if unpack.eof:  # members may follow each other
                        data, unpack = unpack.unused_data.lstrip(b"\n\0"), zlib.decompressobj(31)
                    *lines, tail = tail.replace(b"\r\n", b"\n").split(b"\n")
                    if lines:
                        yield out(path, number, lines)
                        number += len(lines)
            if tail:
                yield out(path, number, [tail])

    def out(path: str, number: int, lines: list[bytes]) -> pa.RecordBatch:
        columns = [pa.array([path] * len(lines)), pa.array(range(number + 1, number + len(lines) + 1), pa.int64()), pa.array([x.decode("utf-8", "replace") for x in lines])]
        return pa.RecordBatch.from_arrays(columns, names=["source_path", "line_number", "raw"])

    raw = split_lines(spark.read.option("lineSep", "\n").text(paths)).withColumn("at", F.monotonically_increasing_id())
    parts = raw.select("uri", "block", "at", F.col("value").cast("binary").alias("part")).repartition("uri").sortWithinPartitions("uri", "block", "at")
    found = parts.mapInArrow(run, "source_path string, line_number bigint, raw string")
    path = source_path(F.col("source_path"))
    return dealt(found).select(path.alias("source_path"), source_name(path).alias("source_name"), "line_number", "raw")


def read_lines(spark: SparkSession, *paths: str, detect_gzip: bool = True) -> DataFrame:
    """source_path, source_name, line_number (from 1, blank lines count) and raw of every line.

    Compressed files are known by their extension; with detect_gzip also by their first bytes, which the
    scan that counts the lines looks at; only such files' names come to the driver. Invalid UTF-8 becomes
    U+FFFD. Blank lines are kept here, since formats are told from the first lines; `events` drops them.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        # Else files are split by the cores there are at the time, which may change while executors come and go.
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    rows = split_lines(spark.read.text(list(paths))).withColumn("at", F.monotonically_increasing_id())
    splits = survey(rows)
    lines = numbered(rows, splits if detect_gzip else splits.withColumn("gzip", F.lit(False)))
    gzipped = [r.uri for r in splits.filter("gzip").select("uri").distinct().collect()] if detect_gzip else []
    return lines.unionByName(read_misnamed_gzip(spark, gzipped)) if gzipped else lines

"""Events of files as they arrive, by Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelog.operators.events import assembled, parts
from shapelog.operators.templates import match, train
from shapelog.sources.lines import numbered, split_lines
from shapelog.sources.shared import keep, latest
from shapelog.sources.sinks import flatten


def stream_files(spark: SparkSession, folder: str, max_files: int = 100) -> DataFrame:
    """A stream of (uri, block, value): the lines of a folder's new files, each file whole in one batch."""
    return split_lines(spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(folder))


def stream_events(spark: SparkSession, folder: str, out: str, checkpoint: str, now: Column | None = None, mined: DataFrame | None = None, codebook: DataFrame | None = None, each: Callable[[DataFrame, int], None] | None = None, available_now: bool = True):
    """Start a query that turns each new file's lines into events, written under `out` by batch.

    A batch writes a folder of its own, and writing it again after a failure replaces it, so every
    event is there once. Without `mined`, templates are kept beside the checkpoint after each batch and
    the next one goes on from them; a batch that is run again goes on from the one before it. `each`
    gets a batch's events for further sinks.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        parsed, rest = parts(numbered(batch))
        known = mined
        if known is None:
            state = f"{checkpoint}-templates"
            known = keep(train(rest, known=latest(batch.sparkSession, state, batch_id)), state, batch_id)
        found = assembled(parsed, match(rest, known, codebook), now)
        path = f"{out}/batch={batch_id}"
        flatten(found).write.mode("overwrite").parquet(path)
        if each is not None:
            each(spark.read.parquet(path), batch_id)

    writer = stream_files(spark, folder).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def distinct_events(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """A stream of events (with event_ts) without those of an id seen within the delay."""
    return stream.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def windowed_counts(stream: DataFrame, width: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Events per window of event time and action."""
    return stream.withWatermark("event_ts", delay).groupBy(F.window("event_ts", width), "action").agg(F.count("*").alias("events"))

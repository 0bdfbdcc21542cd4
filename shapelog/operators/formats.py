"""The format of each file, from its first lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapelog.functions.sniff import commas, csv_header, sniff_line
from shapelog.functions.text import settled
from shapelog.sources.shared import join_small

#: Lines of a file that are looked at.
SAMPLE = 6


def file_formats(lines: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(source_path, source_name, format, header): csv by its header and even commas, else a vote of the lines.

    Ties go to the label that comes first in the file; a file without votes is unknown. header is
    the first line of a csv file.
    """
    first = lines.filter(F.col("line_number") <= sample)
    top = first.groupBy("source_path").agg(F.min("source_name").alias("source_name"), F.sort_array(F.collect_list(F.struct("line_number", "raw"))).alias("top"))
    header = F.col("top")[0]["raw"]
    body = F.slice("top", 2, sample)
    even = F.forall(body, lambda x: (F.regexp_replace(x["raw"], r"(?U)\s", "") == "") | (commas(x["raw"]) == commas(header)))
    csv = (F.size(body) > 0) & csv_header(header) & even
    # Settled, as the filter would else move to where the lines are read, and look at all of them.
    votes = settled(first.select("source_path", "line_number", sniff_line(F.col("raw")).alias("label")), "first").filter(~F.col("label").isin("empty", "csv_like"))
    counted = votes.groupBy("source_path", "label").agg(F.count("*").alias("n"), F.min("line_number").alias("at"))
    winner = counted.groupBy("source_path").agg(F.min_by("label", F.struct(-F.col("n"), F.col("at"))).alias("label"))
    joined = top.join(winner, "source_path", "left")
    label = F.when(csv, "csv").otherwise(F.coalesce("label", F.lit("unknown")))
    return joined.select("source_path", "source_name", label.alias("format"), F.when(csv, header).alias("header"))


def with_format(lines: DataFrame, formats: DataFrame | None = None) -> DataFrame:
    """The lines with the format and header of their file.

    The files' formats are found first and kept, a row a file. As long as they are few, they are broadcast,
    so that no line is shuffled, whatever file it is of; beyond that both sides are.
    """
    known = (formats if formats is not None else file_formats(lines)).select("source_path", "format", "header").persist()
    return join_small(lines, known, ["source_path"])

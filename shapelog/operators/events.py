"""Lines to events: detect, parse, normalize; what no parser takes goes by template, nothing is dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapelog.functions import parse
from shapelog.functions.scalars import lineage
from shapelog.functions.text import Stages, settled
from shapelog.operators import normalize, templates
from shapelog.operators.formats import with_format
from shapelog.sources.shared import shared_folder, written

MAP = "map<string,string>"


def with_fields(lines: DataFrame, books: list[dict] | None = None, shapes: list[str] | None = None) -> DataFrame:
    """Adds `fields`, by the parser of the line's format; null where it rejects the line.

    shapes: the formats that occur, if that is known; the plan then holds their parsers only.
    """
    raw, form = F.col("raw"), F.col("format")
    header = F.col("header") if "header" in lines.columns else F.lit(None).cast("string")
    parsers = {
        "json": lambda: parse.parse_json(raw), "csv": lambda: parse.parse_csv(header, raw), "kv_syslog": lambda: parse.parse_kv(raw), "cef": lambda: parse.parse_cef(raw),
        "leef": lambda: parse.parse_leef(raw), "syslog5424": lambda: parse.parse_rfc5424(raw), "coded_syslog": lambda: parse.parse_coded(raw, books),
    }
    fields, stages = F.when(form.isNull(), None), Stages()
    with stages:
        for shape in parsers if shapes is None else [s for s in parsers if s in shapes]:
            with stages.only(form == shape):
                fields = fields.when(form == shape, parsers[shape]())
    return settled(stages.add(lines, fields=fields.cast(MAP)), "lines")


def structured_event(stages: Stages, form: Column, fields: Column, raw: Column, shapes: list[str] | None = None) -> Column:
    builders = {
        "json": lambda f: normalize.json_event(f, raw), "csv": normalize.csv_event, "kv_syslog": normalize.kv_event, "cef": normalize.cef_event, "leef": normalize.leef_event,
        "syslog5424": normalize.rfc5424_event, "coded_syslog": normalize.coded_event,
    }
    event = F
    for shape in builders if shapes is None else [s for s in builders if s in shapes]:
        with stages.only(form == shape):
            event = event.when(form == shape, builders[shape](fields))
    return event


def _finish(rows: DataFrame, stages: Stages, event: Column, now: Column | None) -> DataFrame:
    with stages:
        whole = normalize.finalize(event, now)
    own = lineage(F.col("source_path"), F.col("source_name"), F.col("line_number"), F.col("raw"))
    done = stages.add(rows.select("source_path", "source_name", "line_number", "raw", *(c for c in ("format", "fields", "template", "variables") if c in rows.columns)), event=whole, lineage=own)
    return settled(done.select(F.col("lineage.event_id").alias("event_id"), "event.*", "lineage", "raw"), "events")


def parsed_lines(lines: DataFrame, books: list[dict] | None = None, shapes: list[str] | None = None) -> DataFrame:
    """Lines that aren't blank, with format and fields; a table's header goes and its rows count from 1."""
    # Settled, as the filters would else run where lines that are then dealt out are unpacked, which is one task.
    known = settled(lines if "format" in lines.columns else with_format(lines), "read")
    csv = F.col("format") == "csv"
    rows = known.filter(F.col("raw").rlike(r"(?U)\S")).filter(~csv | (F.col("line_number") > 1))
    rows = rows.withColumn("line_number", F.when(csv, F.col("line_number") - 1).otherwise(F.col("line_number")))
    return with_fields(rows, books, shapes)


def template_events(hits: DataFrame, now: Column | None = None) -> DataFrame:
    """Events of lines that `templates.match` or `templates.mine_online` gave templates."""
    stages = Stages()
    with stages:
        event = normalize.template_event(F.col("template"), F.col("variables"), F.col("raw"))
    return _finish(hits, stages, event, now)


def structured_events(parsed: DataFrame, now: Column | None = None, shapes: list[str] | None = None) -> DataFrame:
    rows, stages = parsed.filter("fields IS NOT NULL"), Stages()
    with stages:
        event = structured_event(stages, F.col("format"), F.col("fields"), F.col("raw"), shapes)
    return _finish(rows, stages, event, now)


def parts(lines: DataFrame, books: list[dict] | None = None) -> tuple[DataFrame, DataFrame]:
    """The parsed lines, and those that no parser takes: these are written once, as templates are trained on them and matched with them."""
    parsed = parsed_lines(lines, books)
    rest = parsed.filter("fields IS NULL").select("source_path", "source_name", "line_number", "raw")
    return parsed, written(rest, f"{shared_folder(lines.sparkSession)}/rest")


def assembled(parsed: DataFrame, hits: DataFrame, now: Column | None = None) -> DataFrame:
    return structured_events(parsed, now).unionByName(template_events(hits, now))


def events(lines: DataFrame, now: Column | None = None, mined: DataFrame | None = None, codebook: DataFrame | None = None, books: list[dict] | None = None, mode: str = "converged") -> DataFrame:
    """The event of every line that isn't blank.

    lines: source_path, source_name, line_number, raw, and format and header if they are known
    already. mined: templates of an earlier run; else the lines at hand train their own. mode
    "online" reports each line's template as of that line.
    """
    parsed, rest = parts(lines, books)
    hits = templates.mine_online(rest) if mode == "online" else templates.match(rest, mined if mined is not None else templates.train(rest), codebook)
    return assembled(parsed, hits, now)

"""Output of events: JSON lines, bulk requests, Parquet, an index mapping and an HTML page."""

from __future__ import annotations

import html
import json
import zlib
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapelog.operators import summary
from shapelog.schema import EVENT_FIELDS, LINEAGE_FIELDS
from shapelog.sources.shared import shared_folder, written

INDEX = "shapelog-events"


def document(events: DataFrame) -> Column:
    """The event as JSON with @timestamp; nulls are written."""
    return F.to_json(F.struct(*events.columns, F.col("timestamp").alias("@timestamp")), {"ignoreNullFields": "false"})


def jsonl(events: DataFrame) -> DataFrame:
    return events.select(document(events).alias("value"))


def bulk_ndjson(events: DataFrame, index: str = INDEX) -> DataFrame:
    """Action and document of each event as one value of two lines, so that writers keep them together.

    The event_id is the document's id: what is sent twice is stored once.
    """
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), F.col("event_id").alias("_id")).alias("index")))
    return events.select(F.concat(action, F.lit("\n"), document(events)).alias("value"))


def flatten(events: DataFrame) -> DataFrame:
    """27 fixed columns, the lineage's fields at the end."""
    return events.select(*(n for n, _, _ in EVENT_FIELDS), "raw", *(F.col(f"lineage.{n}").alias(f"lineage_{n}") for n, _, _ in LINEAGE_FIELDS))


def write_all(events: DataFrame, folder: str, index: str = INDEX) -> None:
    """All file sinks, packed. The events are written as Parquet once, and the text sinks read that.

    The text sinks hold every event with all its names, so unpacked they are many times the lines they come from.
    """
    flatten(events).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/events.parquet")
    back = unflatten(events.sparkSession.read.parquet(f"{folder}/events.parquet"))
    for name, rows in (("all_events.jsonl", jsonl(back)), ("bulk.ndjson", bulk_ndjson(back, index)), ("docs.ndjson", jsonl(back))):
        rows.write.mode("overwrite").option("compression", "gzip").text(f"{folder}/{name}")


def unflatten(rows: DataFrame) -> DataFrame:
    return rows.select(*(n for n, _, _ in EVENT_FIELDS), F.struct(*(F.col(f"lineage_{n}").alias(n) for n, _, _ in LINEAGE_FIELDS)).alias("lineage"), "raw")


def index_mapping() -> dict:
    fields = {n: {"type": kind} for n, _, kind in EVENT_FIELDS} | {"@timestamp": {"type": "date"}, "raw": {"type": "text"}}
    return {"mappings": {"properties": fields | {"lineage": {"properties": {n: {"type": kind} for n, _, kind in LINEAGE_FIELDS}}}}}


def write_mapping(path: str) -> str:
    Path(path).write_text(json.dumps(index_mapping(), indent=2), encoding="utf-8")
    return path


def color(name: str) -> str:
    """The same color for a name in every run."""
    return f"hsl({zlib.crc32(name.encode()) % 360} 55% 48%)"


def _bars(title: str, rows: list[tuple[str, int]]) -> str:
    most = max((n for _, n in rows), default=1)
    items = "".join(f'<tr><td>{html.escape(str(k))}</td><td><i style="width:{100 * n / most:.1f}%;background:{color(str(k))}"></i></td><td>{n:,}</td></tr>' for k, n in rows)
    return f"<section><h2>{html.escape(title)}</h2><table class=bars>{items}</table></section>"


def _ring(title: str, rows: list[tuple[str, int]]) -> str:
    total, at, stops, key = sum(n for _, n in rows) or 1, 0.0, [], ""
    for k, n in rows:
        stops.append(f"{color(str(k))} {at:.2f}% {at + 100 * n / total:.2f}%")
        at += 100 * n / total
        key += f'<li style="color:{color(str(k))}">{html.escape(str(k))} {100 * n / total:.1f}%</li>'
    return f'<section><h2>{html.escape(title)}</h2><div class=ring style="background:conic-gradient({",".join(stops) or "#ccc 0 100%"})"></div><ul>{key}</ul></section>'


STYLE = "body{font:14px system-ui;margin:2em;background:#f6f7f9}section{background:#fff;padding:1em;margin:.5em;display:inline-block;vertical-align:top}i{display:block;height:.8em}.bars td:nth-child(2){width:14em}.ring{width:9em;height:9em;border-radius:50%}#events td{padding:.2em .6em}"
SCRIPT = "const b=document.querySelector('#events tbody');document.querySelector('#q').oninput=e=>{for(const r of b.rows)r.hidden=!r.textContent.toLowerCase().includes(e.target.value.toLowerCase())};document.querySelectorAll('#events th').forEach((h,i)=>{let up=1;h.onclick=()=>{up=-up;[...b.rows].sort((x,y)=>up*x.cells[i].textContent.localeCompare(y.cells[i].textContent,undefined,{numeric:true})).forEach(r=>b.append(r))}})"


def dashboard(events: DataFrame, title: str = "Events") -> str:
    """A page of totals, charts and the first events, from aggregates of bounded size.

    The columns that it shows are written once, as each number is a scan of its own and lines are dear to parse.
    """
    columns = ["timestamp", "vendor", "source_format", "action", "src_ip", "dst_ip", "confidence"]
    lineage = F.struct("lineage.source_path", "lineage.line_number").alias("lineage")
    events = written(events.select(*columns, lineage), f"{shared_folder(events.sparkSession)}/shown")
    t = summary.totals(events).first()
    pairs = lambda df: [(r[0], r["events"]) for r in df.collect()]
    most = lambda column, n: pairs(summary.top(events.withColumn(column, summary.or_unknown(column)), column, n))
    rows = "".join("<tr>" + "".join(f"<td>{html.escape('' if r[c] is None else str(r[c]))}</td>" for c in columns) + "</tr>" for r in summary.sample(events).select(*columns).collect())
    head = "".join(f"<th>{c}</th>" for c in columns)
    kpis = [("events", f"{t.events:,}"), ("deny rate", f"{t.deny_rate:.1f}%"), ("average confidence", f"{t.avg_confidence:.2f}"), ("source addresses", f"{t.src_ips:,}"), ("formats", t.formats), ("vendors", t.vendors)]
    parts = [f"<section><h2>{k}</h2><b>{v}</b></section>" for k, v in kpis]
    parts += [_ring("Actions", most("action", summary.TOP_SHARES)), _bars("Confidence", pairs(summary.confidence_histogram(events)))]
    parts += [_bars(name, most(column, summary.TOP_BARS)) for name, column in (("Formats", "source_format"), ("Vendors", "vendor"))]
    parts += [_bars("Source addresses", pairs(summary.top(events, "src_ip"))), _bars("Years", pairs(summary.by_year(events)))]
    table = f"<section><input id=q placeholder=filter><table id=events><thead><tr>{head}</tr></thead><tbody>{rows}</tbody></table></section>"
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><style>{STYLE}</style><h1>{html.escape(title)}</h1>{''.join(parts)}{table}<script>{SCRIPT}</script>"


def write_dashboard(events: DataFrame, path: str, title: str = "Events") -> str:
    Path(path).write_text(dashboard(events, title), encoding="utf-8")
    return path

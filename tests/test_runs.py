"""Runs that go on from the ones before, onboarding, the command line, and a stream's templates."""

import gzip
import json

from pyspark.sql import functions as F
from test_functions import sample

from shapelog import run
from shapelog.__main__ import main
from shapelog.operators import templates
from shapelog.sources.shared import latest
from shapelog.streaming.events import stream_events


def free(lo, hi):
    return "".join(f"session {i} opened for user u{i % 7} by root\n" if i % 3 else f"cache took {i} ms\n" for i in range(lo, hi))


def test_two_runs(spark, tmp_path):
    (tmp_path / "a.log").write_text(free(0, 60))
    (tmp_path / "b.log").write_text("a=1 b=2 srcip=1.2.3.4\n" * 5 + "nothing here\n\n")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    first = run.process(spark, [str(tmp_path / "a.log"), str(tmp_path / "b.log")], out, state)
    assert first["events"].count() == 66 and first["promoted"].count() == 2
    assert {r.template: r.size for r in latest(spark, f"{state}/templates").collect()}["cache took <*> ms"] == 20
    (tmp_path / "a.log").write_text(free(60, 90))
    second = run.process(spark, [str(tmp_path / "a.log")], str(tmp_path / "out2"), state)
    sizes = {r.template: r.size for r in latest(spark, f"{state}/templates").collect()}
    assert sizes["cache took <*> ms"] == 30 and sizes["session <*> opened for user <*> by root"] == 60 and sizes["nothing here"] == 1
    assert second["promoted"].count() == 0 and second["registry"].filter("source_name = 'a'").first().files_processed == 2
    text = [r.line for r in run.report(first["events"], first["promoted"], 2.0).collect()]
    assert text[0].startswith("a ") and "60 events" in text[0] and text[2:5] == ["high   confidence: 5 events, 7.6%", "low    confidence: 61 events, 92.4%", "medium confidence: 0 events, 0.0%"]
    assert "66 events, 0 denied" in text[5] and "33 events a second" in text[5] and len(text) == 8


def test_resumed_training_is_one_training(spark):
    rows = [("/a", "a", i + 1, x) for i, x in enumerate((free(0, 90)).splitlines())]
    table = spark.createDataFrame(rows, "source_path string, source_name string, line_number bigint, raw string")
    whole = {(r.template, r.size, r.example_line) for r in templates.train(table).collect()}
    first = templates.train(table.filter("line_number <= 40"))
    again = templates.train(table.filter("line_number > 40"), known=first)
    assert {(r.template, r.size, r.example_line) for r in again.collect()} == whole
    parted = templates.train(table.filter("line_number > 40"), known=first, leaf_lines=7)
    assert {(r.template, r.size) for r in parted.collect()} == {(t, n) for t, n, _ in whole}
    assert templates.train(table.limit(0), known=first).count() == first.count()


def test_onboard(spark, tmp_path):
    (tmp_path / "pan.log").write_text("".join(f"<1>Jan 1 2024 00:00:00 f : %PAN-1-{100 + i % 2}: x {i}\n" for i in range(5)))
    (tmp_path / "j.log").write_bytes(gzip.compress(b'{"a": 1}\n'))
    (tmp_path / "free.log").write_text(free(0, 9))
    state = str(tmp_path / "state")
    coded = run.onboard(spark, str(tmp_path / "pan.log"), "pan", state, str(tmp_path))
    assert coded["codes"] == 2 and coded["prefix"] == "PAN" and [m["_seen_count"] for m in json.load(open(coded["codebook"]))["messages"]] == [3, 2]
    assert run.onboard(spark, str(tmp_path / "j.log"), "j", state)["needs"] == "nothing"
    free_one = run.onboard(spark, str(tmp_path / "free.log"), "f", state)
    assert (free_one["format"], free_one["lines"], free_one["needs"]) == ("unknown", 9, "review of templates")
    assert {r.source_name for r in latest(spark, f"{state}/registry").collect()} == {"pan", "j", "f"}


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "a.log").write_text(free(0, 30))
    main(["run", str(tmp_path / "a.log"), "--out", str(tmp_path / "o"), "--state", str(tmp_path / "s"), "--dashboard", str(tmp_path / "page.html")])
    assert "30 events" in capsys.readouterr().out and "conic-gradient" in (tmp_path / "page.html").read_text()
    main(["onboard", str(tmp_path / "a.log"), "a", "--state", str(tmp_path / "s")])
    assert json.loads(capsys.readouterr().out)["format"] == "unknown"


def test_stream_goes_on_from_templates(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for part in range(2):
        (folder / f"s{part}.log").write_text(free(45 * part, 45 * part + 45))
        stream_events(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    kept = latest(spark, f"{tmp_path}/check-templates")
    assert kept.agg(F.sum("size")).first()[0] == 90 and kept.count() == 4  # two templates of each file's source
    assert spark.read.parquet(str(tmp_path / "out")).count() == 90


def test_report_of_the_sample(spark):
    from shapelog.operators.events import events

    assert len(run.report(events(sample(spark))).collect()) == 5

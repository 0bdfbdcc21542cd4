"""python -m shapelog run PATH... --out FOLDER --state FOLDER, or onboard FILE NAME --state FOLDER."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from shapelog import run


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shapelog")
    commands = parser.add_subparsers(dest="command", required=True)
    whole = commands.add_parser("run", help="files or folders to events, with a report")
    whole.add_argument("paths", nargs="+")
    whole.add_argument("--out", required=True)
    whole.add_argument("--state", required=True)
    whole.add_argument("--dashboard", help="a page of HTML, written on the driver")
    one = commands.add_parser("onboard", help="take up a sample as a source")
    one.add_argument("sample")
    one.add_argument("name")
    one.add_argument("--state", required=True)
    one.add_argument("--folder", default=".")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("shapelog").getOrCreate()
    if given.command == "onboard":
        print(json.dumps(run.onboard(spark, given.sample, given.name, given.state, given.folder), indent=2))
        return
    found = run.process(spark, given.paths, given.out, given.state)
    for row in run.report(found["events"], found["promoted"], found["seconds"]).collect():  # a line a file and a promoted template
        print(row.line)
    if given.dashboard:
        print(run.sinks.write_dashboard(found["events"], given.dashboard))


if __name__ == "__main__":
    main()

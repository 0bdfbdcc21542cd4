"""Text sinks are packed and hold every event."""

import json

from test_functions import sample

from shapelog.operators.events import events
from shapelog.sources import sinks


def test_text_sinks_are_packed(spark, tmp_path):
    found = events(sample(spark))
    sinks.write_all(found, str(tmp_path))
    ids = sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/events.parquet").collect())
    for name in ("all_events.jsonl", "docs.ndjson", "bulk.ndjson"):
        parts = list((tmp_path / name).glob("part-*"))
        assert parts and all(p.suffix == ".gz" for p in parts)
        docs = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/{name}").collect()]
        assert sorted(d["event_id"] for d in docs if "event_id" in d) == ids

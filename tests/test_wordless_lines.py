"""Lines of separators only keep their place in both ways of mining."""

from shapelog.operators import templates
from shapelog.operators.events import events

RAWS = ["|||", "a b c", ",", "a b d", "| ,|", "a,b,e", "|||", "one"]


def lines(spark):
    rows = [(f"/logs/{s}", s, i + 1, raw) for s in ("x", "y") for i, raw in enumerate(RAWS)]
    return spark.createDataFrame(rows, "source_path string, source_name string, line_number bigint, raw string").repartition(3)


def test_mine_online_keeps_wordless_lines(spark):
    online = templates.mine_online(lines(spark))
    matched = templates.match(lines(spark), templates.train(lines(spark)))
    place = ["source_name", "line_number", "raw"]
    got, want = ({tuple(r[c] for c in place): r for r in df.collect()} for df in (online, matched))
    assert len(got) == 2 * len(RAWS) and set(got) == set(want)
    for key, row in got.items():
        if not key[2].strip("|, "):
            assert (row.template, row.cluster_size, row.variables, row.learned) == ("", 1, [], False)
            assert (row.template, row.cluster_size, row.variables) == (want[key].template, want[key].cluster_size, want[key].variables)
    assert [got["x", i, r].cluster_size for i, r in enumerate(RAWS, 1) if r[0] == "a"] == [1, 2, 3]


def test_online_events_of_every_line(spark):
    from pyspark.sql import functions as F

    rows = lines(spark).withColumns({"format": F.lit("unknown"), "header": F.lit(None).cast("string")})
    found = {mode: sorted(r.raw for r in events(rows, mode=mode).select("raw").collect()) for mode in ("online", "converged")}
    assert found["online"] == found["converged"] == sorted(2 * RAWS)

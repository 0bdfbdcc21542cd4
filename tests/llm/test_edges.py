"""Null, repeated and textual ids, empty tables and clashing names, for the operators on places and links."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import text

from shapelog.llm import line_dedup, ngram_join, substring_dedup, suffix_dedup
from shapelog.llm.common import work_dir
from shapelog.llm.components import components

BASE, PASSAGE = text(150, 61), text(80, 62)
LINES = "\n".join(f"line {i}" for i in range(6))
ROWS = [
    ("b", BASE), ("a", BASE), (None, BASE), ("a", BASE), ("c", None), ("c", ""), ("c", text(20, 63) + " " + PASSAGE), ("c", PASSAGE + " " + text(20, 64)), ("10", PASSAGE), ("9", text(30, 65) + " " + PASSAGE),
    ("d", LINES), ("d", LINES), ("d", "x\n" + LINES), ("é", LINES + "\ny"), (None, None), (None, " "), ("zz", "w " * 120), ("zz", "w " * 120), ("e", BASE.replace(" ", "  ")),
]
NUMBERS = {x: i - 5 for i, x in enumerate(sorted({i for i, _ in ROWS if i is not None}))}
SCHEMA = "text string, doc string, rid string, lo int, rows int, a string, doc_id {}"


def order(i):
    return i is None, i if i is not None else ""


@pytest.fixture(scope="module", params=["string", "bigint"])
def table(request, spark):
    """Rows with ids of a kind (in the same order), and the hashes of the texts."""
    kind = request.param
    ids = [i if kind == "string" or i is None else NUMBERS[i] for i, _ in ROWS]
    df = spark.createDataFrame([(t, "d", "r", 1, 2, "a", i) for i, (_, t) in zip(ids, ROWS)], SCHEMA.format(kind)).repartition(3)
    rids = {r.text or "": r.h for r in df.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    return df, [(i, t or "", rids[t or ""]) for i, (_, t) in zip(ids, ROWS)]


def same(df, columns, want):
    got = [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in df.select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_substring_dedup(spark, table):
    df, rows = table
    first = {}
    for i, t, _ in rows:
        w = t.split()
        for p in range(len(w) - 49):
            key = tuple(w[p : p + 50])
            first[key] = min(first.get(key, order(i)), order(i))
    want = []
    for i, t, _ in rows:
        w = t.split()
        gone = {q for p in range(len(w) - 49) if first[tuple(w[p : p + 50])] < order(i) for q in range(p, p + 50)}
        want.append((i, len(w), len(gone)))
    same(substring_dedup.substring_dedup(df, work_dir(spark)), ["doc_id", "n_words", "n_removed"], want)
    assert substring_dedup.substring_dedup(df.limit(0), work_dir(spark)).count() == 0


def test_suffix_dedup(spark, table):
    df, rows = table
    raw = [(i, t.encode()) for i, t, _ in rows]
    seen = Counter(x[p : p + 400] for _, x in raw for p in range(len(x) - 399))
    want = []
    for i, x in raw:
        gone = np.zeros(len(x), bool)
        for p in range(len(x) - 399):
            if seen[x[p : p + 400]] > 1:
                gone[p : p + 400] = True
        want.append((i, len(x), int(gone.sum())))
    same(suffix_dedup.suffix_dedup(df, work_dir(spark)), ["doc_id", "n_bytes", "n_removed"], want)
    assert suffix_dedup.suffix_dedup(df.limit(0), work_dir(spark)).count() == 0


def test_line_dedup(spark, table):
    df, rows = table
    places = {}
    for i, t, h in rows:
        x = t.split("\n") if t else []
        for p in range(len(x) - 2):
            key = tuple(x[p : p + 3])
            places[key] = min(places.get(key, (order(i), h, p)), (order(i), h, p))
    want = []
    for i, t, h in rows:
        x = t.split("\n") if t else []
        gone = {q for p in range(len(x) - 2) if places[tuple(x[p : p + 3])] < (order(i), h, p) for q in range(p, p + 3)}
        want.append((i, len(x), len(gone)))
    same(line_dedup.line_dedup(df, work_dir(spark)), ["doc_id", "n_lines", "n_removed"], want)
    assert line_dedup.line_dedup(df.limit(0), work_dir(spark)).count() == 0


def test_ngram_join(spark, table):
    df, rows = table
    sets = []
    for _, t, _ in rows:
        w = t.lower().split()
        sets.append({tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4))} if w else set())
    groups = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    groups[i] = groups[j] = min(groups[i], groups[j])
    root = {g: min((order(rows[i][0]), rows[i][0]) for i in range(len(rows)) if groups[i] == g)[1] for g in set(groups)}
    want = [(i, len(s), root[g]) for (i, _, _), s, g in zip(rows, sets, groups)]
    same(ngram_join.ngram_join(df, work_dir(spark)), ["doc_id", "n_shingles", "component_id"], want)
    assert ngram_join.ngram_join(df.limit(0), work_dir(spark)).count() == 0


def test_components(spark):
    """Long paths, a star that holds most edges, repeated edges and loops, and no edge at all."""
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(300)] + [(500, 501), (501, 500), (500, 501), (700, 700), (-3, -2), (-2, -1)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), work_dir(spark)).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(300)} | {500: 500, 501: 500, -3: -3, -2: -3, -1: -3}
    assert components(spark.createDataFrame([], "a bigint, b bigint"), work_dir(spark)).count() == 0


def test_no_shared_folder_on_a_cluster(spark, monkeypatch):
    class Cluster:
        master = "spark://somewhere:7077"

    class Session:
        conf, sparkContext = spark.conf, Cluster

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            work_dir(Session)

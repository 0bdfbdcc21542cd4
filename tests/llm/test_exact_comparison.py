"""Words that collide in polynomial hashes, graph steps, and links on sets against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import got, text

from shapelog.llm import kernels, ngram_join, spans, substring_dedup, suffix_dedup
from shapelog.llm.common import join_keyed, materialize, work_dir


def thue_morse(a, b):
    """A word of 1,024 characters whose polynomial hash modulo 2**64 is that of its swap."""
    return "".join(b if bin(i).count("1") % 2 else a for i in range(1024))


SWAPPED = thue_morse("a", "b"), thue_morse("b", "a")


def test_words_of_equal_polynomial_hash(spark):
    around = text(30, 1), text(30, 2)
    docs = spark.createDataFrame([(i, f"{around[0]} {w} {around[1]}") for i, w in enumerate(SWAPPED)], "doc_id bigint, text string")
    assert got(substring_dedup.substring_dedup(docs, work_dir(spark)), "doc_id", "n_words", "n_removed") == [(0, 61, 0), (1, 61, 0)]
    short = spark.createDataFrame([(i, f"x y {w} z") for i, w in enumerate(SWAPPED)], "doc_id bigint, text string")
    assert got(ngram_join.ngram_join(short, work_dir(spark)), "doc_id", "n_shingles", "component_id") == [(0, 1, 0), (1, 1, 1)]


def test_word_hashes_do_not_depend_on_place():
    raw = np.frombuffer(b"ab  ba ab\nabc b a", np.uint8)
    starts, ends, _ = kernels.words(raw, np.array([0, len(raw)]))
    h = kernels.word_hashes(raw, starts, ends)
    assert h[0] == h[2] and len(set(h.tolist())) == 5
    content, begin, end = kernels.joined(raw, starts, ends)
    assert content.tobytes() == b"ab ba ab abc b a " and [content[a:b].tobytes() for a, b in zip(begin, end)] == [b"ab", b"ba", b"ab", b"abc", b"b", b"a"]
    assert (kernels.word_hashes(content, begin, end) == h).all()


def spans_of(docs, folder):
    return substring_dedup.repeated_spans(spans.keyed(docs, folder)[0], folder)


def test_long_spans_and_their_sources(spark):
    """A copied passage of any length is one span with its place in the source; an edit parts it in two."""
    source = text(400, 11).split()
    edited = [*source[50:350]]
    edited[140] = "edited"
    docs = spark.createDataFrame([(0, " ".join(source)), (1, " ".join([*text(20, 12).split(), *source[100:300], *text(20, 13).split()])), (2, " ".join(edited)), (3, text(300, 14))], "doc_id bigint, text string")
    found = spans_of(docs, work_dir(spark))
    # Paths that branch are copied piece by piece; all pieces of a document together are its long spans.
    pieces = {}
    for r in found.select("doc", "lo", "len", "source", "source_lo").collect():
        pieces.setdefault(r.doc, set()).update(range(r.lo, r.lo + r.len))
        assert r.source < r.doc
        if r.source_lo is not None and r.source == 0:
            words = {1: [*text(20, 12).split(), *source[100:300], *text(20, 13).split()], 2: edited}[r.doc]
            assert words[r.lo : r.lo + r.len] == source[r.source_lo : r.source_lo + r.len]
    assert pieces == {1: set(range(20, 220)), 2: {*range(140), *range(141, 300)}}


def test_copies_compact_to_one_path(spark):
    """Two equal documents: every node inside is passed once, so all edges are one nonbranching path."""
    same = text(500, 21)
    docs = spark.createDataFrame([(0, same), (1, same), (2, same)], "doc_id bigint, text string")
    rows = spans_of(docs, work_dir(spark)).select("doc", "lo", "len", "source", "source_lo").collect()
    assert sorted(map(tuple, rows)) == [(1, 0, 500, 0, 0), (2, 0, 500, 0, 0)]


@pytest.mark.parametrize("percent", [75, 40])
@pytest.mark.parametrize("slice_", [1 << 14, 64])
def test_links_by_brute_force(monkeypatch, percent, slice_):
    monkeypatch.setattr(ngram_join, "SLICE", slice_)
    rng = np.random.default_rng(3)
    base = [np.unique(rng.integers(0, 400, rng.integers(1, 200)).astype(np.uint64)) for _ in range(15)]
    sets = [np.unique(np.concatenate([x[rng.random(len(x)) > cut], rng.integers(0, 500, extra).astype(np.uint64)])) for x in base for cut, extra in ((0, 0), (0.1, 3), (0.2, 5), (0.5, 2))]
    sets = [x for x in sets if len(x)]
    linked = lambda x, y: 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y))
    a, b = ngram_join.links(sets, None, percent)
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if linked(sets[i], sets[j])}
    assert {tuple(sorted(x)) for x in zip(a.tolist(), b.tolist())} == want and len(want) > 10
    left, right = sets[::2], sets[1::2]
    a, b = ngram_join.links(left, right, percent)
    assert set(zip(a.tolist(), b.tolist())) == {(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if linked(x, y)}
    assert [len(x) for x in ngram_join.links([], None, percent)] == [0, 0]


@pytest.mark.parametrize("limit", [20_000, 1])
def test_suffix_dedup_of_passages_of_known_length(spark, limit):
    """Passages of 399 bytes stay, of 400 and more go from every text that holds them, and nothing else goes."""
    passages = {n: (text(200, 1000 + n).encode() * 4)[:n].decode() for n in (300, 399, 400, 401, 1500)}
    rows, want = [], []
    for n, passage in passages.items():
        for j in range(3):
            before, after = text(40, 10 * n + j) + "XYZ"[j], "PQR"[j] + text(50, 20 * n + j)
            rows.append((len(rows), before + passage + after))
            want.append((len(want), n if n >= 400 else 0, int(n >= 400)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got(suffix_dedup.suffix_dedup(docs, work_dir(spark), group_limit=limit), "doc_id", "n_removed", "n_spans") == want
    empty = suffix_dedup.suffix_dedup(docs.limit(0), work_dir(spark))
    assert empty.count() == 0


def test_join_keyed(spark):
    folder = work_dir(spark)
    rows = materialize(spark.range(5000).selectExpr("CASE WHEN id < 2000 THEN 0 ELSE id END AS k", "id AS x"), f"{folder}/rows")
    keyed = materialize(rows.groupBy("k").agg(F.count("*").alias("m"), F.min("x").alias("least")).filter("k % 2 = 0"), f"{folder}/keyed")
    assert got(join_keyed(rows, keyed, ["k"], "m"), "k", "x", "least") == got(rows.join(keyed.drop("m"), "k"), "k", "x", "least")
    assert got(join_keyed(rows, keyed, ["k"], "m", "left_semi"), "k", "x") == got(rows.join(keyed, "k", "left_semi"), "k", "x")

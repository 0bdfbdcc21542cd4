"""Substring dedup by De Bruijn compaction over tokens.

Edges of the graph are the windows (k-mers of 50 words), nodes the 49 words that two edges share.
Consecutive windows with a common minimizer travel as one path (a compaction inside the task that
reads the text), and equal paths become one. A minimizer with a single path has no branch inside;
where several paths share a minimizer they may branch or only touch, so those are taken apart into
edges again, and equal edges become one. What repeats in two documents is the graph: its nodes' degrees
are counted, and edges on both sides of a node that doesn't branch compact into one long path, by
joins on the nodes. A copy of a path is a long repeated span if its pieces, compared by the digest of
their own words, stand in the same order and at the same distances as in the source.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shapelog.llm import kernels, spans
from shapelog.llm.common import join_keyed, materialize, release_shuffles, table, work_dir

WINDOW = 50
#: Words of a minimizer.
K = 20
EDGES = "k0 long, k1 long, u long, v long, doc long, rid long, lo int, n int, last long, copies long"

HEAD = ["d", "e", "lo", "n", "last", "single", "copies"]


def graph_edges(docs: DataFrame, heads: DataFrame, window: int) -> DataFrame:
    """Edges of the paths in `heads` at their places: digest k0 and k1, nodes u and v, n windows from word lo on.

    heads: d, e, single, doc, rid, lo, n, last and copies. A single path stays one edge, others fall into windows.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in spans.slices(whole, "text"):
                tokens = spans.word_tokens(*kernels.text_bytes(batch["text"]))
                nodes = kernels.grams(tokens.values, window - 1).view(np.int64)
                rows = batch["rows"]
                count = np.diff(rows.offsets.to_numpy())
                flat = rows.values.slice(rows.offsets[0].as_py(), int(count.sum()))
                d, e, lo, n, last, single, copies = (flat.field(x).to_numpy(zero_copy_only=False) for x in HEAD)
                times = np.where(single, 1, n)
                each = np.repeat(np.arange(len(n)), times)
                step = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
                text = np.repeat(np.arange(batch.num_rows), count)[each]
                size = np.where(single, n, 1)[each]
                place = lo[each] + step
                at = tokens.limits[text] + place
                k0, k1 = d[each], e[each]
                apart = np.flatnonzero(~single[each])
                k0[apart], k1[apart] = tokens.digests(at[apart], at[apart] + window)
                columns = [k0, k1, nodes[at], nodes[at + size], batch["doc"].to_numpy()[text], batch["rid"].to_numpy()[text], place.astype(np.int32), size.astype(np.int32), last[each], copies[each]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=[x.split()[0] for x in EDGES.split(", ")])

    return spans.with_text(docs.select("doc", "rid", "text"), heads, HEAD).mapInArrow(emit, EDGES)


def compacted(marked: DataFrame, folder: str) -> DataFrame:
    """(k0, k1, times, source, source_rid, source_lo, at): of each distinct edge its first place, and the word `at` which its
    nonbranching path starts there.

    marked: edges with `first`, their smallest document, and `times`, the number of their places.
    """
    own = marked.filter("doc = first").groupBy("k0", "k1").agg(F.min("doc").alias("doc"), F.min(F.struct("rid", "lo", "n", "u", "v")).alias("s"), F.first("times").alias("times"))
    graph = materialize(own.select("k0", "k1", "times", "doc", "s.*"), f"{folder}/graph")
    ends = graph.selectExpr("u", "1 AS leaving", "0 AS entering").union(graph.selectExpr("v", "0", "1"))
    degrees = ends.groupBy("u").agg(F.sum("leaving").alias("leaving"), F.sum("entering").alias("entering"))
    degrees = materialize(degrees.selectExpr("u", "leaving", "NOT (leaving = 1 AND entering = 1) AS branches"), f"{folder}/nodes")
    along = Window.partitionBy("doc", "rid").orderBy("lo")  # the places in one text, so bounded by it
    # A path goes on where the node doesn't branch and the edge before it is the one before it in the source.
    begins = F.col("branches") | ~F.lag(F.col("lo") + F.col("n")).over(along).eqNullSafe(F.col("lo"))
    placed = join_keyed(graph, degrees, ["u"], "leaving").withColumn("begins", begins)
    at = F.last(F.when(F.col("begins"), F.col("lo")), ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0))
    return placed.select("k0", "k1", "times", F.col("doc").alias("source"), F.col("rid").alias("source_rid"), F.col("lo").alias("source_lo"), at.alias("at"))


def long_spans(copies: DataFrame, paths: DataFrame, window: int) -> DataFrame:
    """Copies of edges (k0, k1 at doc, rid, lo) that follow each other as in their source, as one span each."""
    found = join_keyed(copies, paths, ["k0", "k1"], "times").withColumn("shift", F.expr("lo - source_lo"))
    same = Window.partitionBy("doc", "rid", "source", "source_rid", "at", "shift").orderBy("lo")
    begins = (~F.lag(F.col("lo") + F.col("n")).over(same).eqNullSafe(F.col("lo"))).cast("int")
    parts = found.withColumn("begins", begins).withColumn("part", F.sum("begins").over(same.rowsBetween(Window.unboundedPreceding, 0)))
    grouped = parts.groupBy("doc", "rid", "source", "source_rid", "at", "shift", "part").agg(F.min("lo").alias("lo"), F.max(F.col("lo") + F.col("n")).alias("end"))
    return grouped.selectExpr("doc", "rid", "lo", f"end - lo + {window - 1} AS len", "source", "source_rid", "lo - shift AS source_lo")


def repeated_spans(docs: DataFrame, folder: str, window: int = WINDOW, k: int = K) -> DataFrame:
    """(doc, rid, lo, len, source, source_rid, source_lo): spans of words whose windows all start in a smaller document
    as well, and where the span stands in the smallest such document.

    docs: as `spans.keyed` makes them.
    """
    runs = materialize(spans.runs(docs, spans.word_tokens, k, window).drop("off"), f"{folder}/runs")
    ends = [F.min("d").alias("d0"), F.max("d").alias("d1"), F.min("e").alias("e0"), F.max("e").alias("e1")]
    shared = runs.groupBy("a").agg(F.count("*").alias("times"), *ends, F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last")
    shared = materialize(shared.selectExpr("a", "times", "times AS copies", "d0 = d1 AND e0 = e1 AS single", "first", "last"), f"{folder}/shared")
    cands = materialize(join_keyed(runs, shared, ["a"], "times"), f"{folder}/candidates")

    several = cands.filter("NOT single").drop("first", "last").withColumn("copies", F.lit(1).cast("bigint"))
    paths = several.groupBy("a", "d", "e").agg(F.count("*").alias("times"), F.min("doc").alias("first"), F.max("doc").alias("last"))
    paths = materialize(paths, f"{folder}/paths")
    known = materialize(join_keyed(several, paths, ["a", "d", "e"], "times"), f"{folder}/several")
    release_shuffles(docs.sparkSession)

    # In a path's first document its edges are told one by one: some may stand in a smaller document, on another path.
    heads = cands.filter("single").unionByName(known).filter("doc = first")
    edges = materialize(graph_edges(docs, heads, window), f"{folder}/edges")
    owners = edges.groupBy("k0", "k1").agg(F.count("*").alias("weight"), F.max("copies").alias("copies"), F.min("doc").alias("first"), F.max("last").alias("last")).filter("first < last")
    owners = materialize(owners.selectExpr("k0", "k1", "weight", "greatest(weight, copies) AS times", "first"), f"{folder}/owners")
    marked = materialize(join_keyed(edges.drop("last", "copies"), owners, ["k0", "k1"], "weight"), f"{folder}/marked")
    chains = materialize(compacted(marked, folder), f"{folder}/chains")
    release_shuffles(docs.sparkSession)

    whole = cands.filter("single AND doc > first").selectExpr("d AS k0", "e AS k1", "doc", "rid", "lo", "n")
    inner = marked.filter("doc > first").select("k0", "k1", "doc", "rid", "lo", "n")
    found = long_spans(whole.unionByName(inner), chains, window)
    # Another document of a path that isn't single holds all of it.
    later = known.filter("doc > first").selectExpr("doc", "rid", "lo", f"n + {window - 1} AS len", "first AS source", "CAST(NULL AS BIGINT) AS source_rid", "CAST(NULL AS INT) AS source_lo")
    return found.unionByName(later)


def substring_dedup(docs: DataFrame, folder: str, window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (its other words, joined by one space).

    A word goes if a window of `window` words over it also starts in a document with a smaller
    doc_id. Null and empty texts have no words; texts under `window` words lose nothing. Rows that
    share a doc_id are one document, none of them smaller than the other; a null doc_id counts as
    the largest. Columns other than doc_id and text are ignored.
    """
    own, _ = spans.keyed(docs, folder)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, texts = [], [], []
            for text, drop in zip(batch["text"].cast(pa.binary()), spans.covered(batch["rows"]), strict=True):
                words = text.as_py().split()
                sizes.append(len(words))
                if len(drop):
                    keep = np.ones(len(words), bool)
                    for lo, hi in drop.tolist():
                        keep[lo:hi] = False
                    words = list(compress(words, keep.tolist()))
                gone.append(sizes[-1] - len(words))
                texts.append(b" ".join(words))
            columns = [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept"])

    found = repeated_spans(own, folder, window, k).select("doc", "rid", "lo", "len")
    kind = dict(docs.dtypes)["doc_id"]
    with_spans = spans.with_text(own, found, ["lo", "len"], "left").select("doc_id", "text", "rows")
    return with_spans.mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept string")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"), work_dir(spark))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)
), later AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM win) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM later),
kept AS (
  SELECT doc_id, count(*) FILTER (g.i IS NULL) AS n_kept, string_agg(word, ' ' ORDER BY p.i) FILTER (g.i IS NULL) AS text
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w) p LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

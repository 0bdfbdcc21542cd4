"""Benchmark decontamination: a prefix-filtered set join over word windows.

An item's window is the set of its shingles (three consecutive words). A text that holds the window
holds every one of its shingles, so it must hold the rarest, and that one alone is joined: the
necessary prefix of a containment join. Rarity is counted over all documents. A joined shingle then
fixes where the window would stand; bounds on position and length discard what can't fit, and the
words around it decide.

One scan of the documents keeps the places whose shingle is in a filter of fixed size, so that of the
texts only the surroundings of such places travel. The filter lets some other places through, the more
the fuller it is; the join drops those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelog.llm.common import materialize, table, work_dir

WINDOW = 10
SHINGLE = 3
#: Bits of the filter of benchmark shingles that each scan task holds (1 MB, whatever the benchmark's size): 2**FILTER_BITS.
FILTER_BITS = 23
#: A table of windows or names is broadcast up to this many bytes, as measured; beyond it, it is shuffled.
BROADCAST_BYTES = 32 << 20

NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z as a-z and nothing else."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, lower))


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NON_WORD), "")


def _shingle(tokens: str, at: str, size: int) -> str:
    return f"xxhash64({size}, {', '.join(f'get({tokens}, {at} + {j})' for j in range(size))})"


def item_windows(items: DataFrame, id_col: str, window: int = WINDOW) -> DataFrame:
    """(item_id, tokens) of every window: `window` consecutive words, or all of a shorter item."""
    own = items.select(F.col(id_col).alias("item_id"), words(F.col("text")).alias("w")).filter("size(w) > 0")
    return own.selectExpr(
        "item_id", f"explode(transform(sequence(0, greatest(size(w) - {window}, 0)), i -> slice(w, i + 1, {window}))) AS tokens"
    )


def shingle_filter(shingles: DataFrame, bits: int = FILTER_BITS) -> Column:
    """2**bits bits as an array of longs, with a bit set for each shingle h: a scalar subquery of one row of fixed size."""
    words = 1 << bits - 6
    slots = shingles.select(F.expr(f"pmod(h, {1 << bits})").alias("s")).selectExpr("s div 64 AS word", "shiftleft(1L, CAST(s % 64 AS INT)) AS bit")
    filled = slots.groupBy("word").agg(F.bit_or("bit").alias("b"))
    every = shingles.sparkSession.range(words).withColumnRenamed("id", "word").join(filled, "word", "left")
    return every.agg(F.sort_array(F.collect_list(F.struct("word", F.coalesce("b", F.lit(0).cast("long")).alias("b")))).alias("x")).select("x.b").scalar()


def small(df: DataFrame, size: Column, limit: int) -> bool:
    """Whether the rows of a written table hold at most `limit` bytes."""
    return (df.agg(F.sum(size)).first()[0] or 0) <= limit


def decontaminate(docs: DataFrame, items: DataFrame, folder: str, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES, filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    docs needs doc_id and text, items item_id and text; other columns are ignored. Null and empty
    texts have no words: such a document has no hits and such an item no windows. Repeated items
    count once. Each text of a repeated or null doc_id is judged by itself; rows that repeat both have
    equal results. A null item_id is not counted among the items, but its windows still hit. Empty
    tables give no rows, or rows without hits.
    """
    windows = materialize(
        item_windows(items, "item_id", window).groupBy("tokens").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids")).selectExpr("xxhash64(tokens) AS wid", "tokens", "size(tokens) AS len", f"least(size(tokens), {SHINGLE}) AS k", "item_ids"),
        f"{folder}/windows",
    )
    by_size = "CASE k " + " ".join(f"WHEN {s} THEN {_shingle('tokens', 'i', s)}" for s in range(1, SHINGLE + 1)) + " END"
    shingles = materialize(
        windows.selectExpr("wid", "len", "k", "tokens", "posexplode(transform(sequence(0, len - k), i -> " + by_size + ")) AS (off, h)"),
        f"{folder}/item_shingles",
    )
    sizes = sorted(r.k for r in windows.select("k").distinct().collect())  # of at most SHINGLE kinds

    # One pass over the texts keeps, of each document, only the places that pass the filter, with the
    # words around them that any window through them could need.
    rid = F.xxhash64(F.coalesce("text", F.lit("")))
    parsed = docs.select("doc_id", rid.alias("rid"), words(F.col("text")).alias("w"), shingle_filter(shingles.select("h").distinct(), filter_bits).alias("known"))
    every = ", ".join(f"transform(sequence(0, size(w) - 1), p -> CASE WHEN p + {s} <= size(w) THEN struct(p, {_shingle('w', 'p', s)} AS h) END)" for s in sizes)
    passes = f"shiftright(get(known, CAST(pmod(x.h, {1 << filter_bits}) div 64 AS INT)), CAST(pmod(x.h, 64) AS INT)) % 2 <> 0"
    near = f"struct(x.p AS p, x.h AS h, greatest(x.p - {window - 1}, 0) AS at, slice(w, greatest(x.p - {window - 1}, 0) + 1, {2 * window}) AS near)"
    found = f"transform(filter(concat({every}), x -> x IS NOT NULL AND {passes}), x -> {near})" if sizes else "CAST(null AS array<struct<p:int,h:bigint,at:int,near:array<string>>>)"
    rows = materialize(parsed.selectExpr("doc_id", "rid", "size(w) AS n_words", f"CASE WHEN size(w) > 0 THEN {found} END AS hits"), f"{folder}/hits")
    hits = rows.filter("size(hits) > 0").selectExpr("doc_id", "rid", "n_words", "inline(hits)")

    rarity = materialize(hits.groupBy("h").agg(F.count("*").alias("df")), f"{folder}/rarity")
    # A window with a shingle that no document has can't occur; min() over the others picks a present one.
    prefix = (
        shingles.join(rarity, "h", "left")
        .groupBy("wid")
        .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "h", "off")).alias("rarest"), F.first("tokens").alias("tokens"))
        .filter("rarest.df > 0")
        .selectExpr("wid", "tokens", "size(tokens) AS len", "rarest.h AS h", "rarest.off AS off")
    )
    prefix = materialize(prefix, f"{folder}/prefix")
    room = F.octet_length(F.array_join("tokens", " ")) + 64
    fits = "p >= off AND p - off + len <= n_words"
    exact = "slice(near, p - off - at + 1, len) = tokens"
    joined = hits.join(F.broadcast(prefix) if small(prefix, room, broadcast_bytes) else prefix.hint("merge"), "h")
    match = materialize(joined.filter(fits).filter(exact).selectExpr("doc_id", "rid", "wid", "p - off AS start", "len").distinct(), f"{folder}/matches")
    # Positions first merge within a document by distinct, then count.
    hit = match.selectExpr("doc_id", "rid", "explode(sequence(start, start + len - 1)) AS p").distinct().groupBy("doc_id", "rid").agg(F.count("*").alias("n_hit"))
    met = materialize(match.groupBy("wid").agg(F.count("*").alias("m")), f"{folder}/met")
    names = materialize(windows.join(met.select("wid"), "wid", "left_semi").select("wid", F.explode("item_ids").alias("item_id")).withColumn("item_id", F.col("item_id").cast("string")), f"{folder}/names")
    which = match.select("doc_id", "rid", "wid").distinct()
    which = which.join(F.broadcast(names) if small(names, F.octet_length("item_id") + 32, broadcast_bytes) else names.hint("merge"), "wid")
    which = which.select("doc_id", "rid", "item_id").distinct().groupBy("doc_id", "rid").agg(F.sort_array(F.collect_list("item_id")).alias("ids"))
    same = hit.doc_id.eqNullSafe(which.doc_id) & (hit.rid == which.rid)
    found_docs = hit.join(which, same, "left").select(hit.doc_id.alias("hit_id"), hit.rid.alias("hit_rid"), "n_hit", "ids")
    counts = rows.select("doc_id", "rid", F.greatest(F.col("n_words"), F.lit(0)).cast("long").alias("n_words"))
    out = counts.join(found_docs, counts.doc_id.eqNullSafe(found_docs.hit_id) & (counts.rid == found_docs.hit_rid), "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), work_dir(spark))


SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM bw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win),
pos AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)
), m AS (SELECT pos.doc_id, pos.i, pos.n, win.item_id FROM pos JOIN win USING (s, n)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

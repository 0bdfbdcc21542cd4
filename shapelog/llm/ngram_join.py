"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence.

Documents with the same set of shingles are one class, one row of the matrix. A pair of classes
with similarity t shares one of the ceil-free prefixes n - ceil(t n) + 1 of its sets, in any one
order of all shingles; the order is by rarity, so common passages come last. The lists of equal
prefix shingles form blocks (all lists with the same first class are one block), and each block
multiplies its incidence rows, sorted by size: only pairs whose sizes allow t are multiplied, overlap
counts accumulate over slices of the n-grams, and after each slice pairs go that what is left of both
sets can't bring to t. A block returns links enough to connect what is
connected, not all pairs.

Shingles are compared by 64 bits, hashed from words whose bytes are mixed with their places: unequal
shingles of two sets of n and m count as equal with a chance of about n m / 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shapelog.llm import kernels, spans
from shapelog.llm.common import join_keyed, materialize, release_memory, release_shuffles, table, work_dir
from shapelog.llm.components import components

SHINGLE = 5
#: Similarity as a percentage.
PERCENT = 75
#: Buckets of the document frequencies, 2**SKETCH_BITS: four bytes each are broadcast, whatever the input.
SKETCH_BITS = 20
SKETCH_PARTS = 64
#: Rows of a block that are multiplied at once; a larger block is a grid of such parts.
BLOCK_ROWS = 4096
#: Lists go by the upper 48 bits of a shingle: two in one list only make more candidates.
LIST_SHIFT = np.uint64(16)
#: Shingles of the sets of one part of a block, on average, at most (a part holds one set at least).
PART_SHINGLES = 1 << 23
#: Bits of the filter of texts whose sets are needed (4 MB are broadcast, whatever the input), 2**FILTER_BITS.
FILTER_BITS = 25
#: N-grams of one slice of the product.
SLICE = 1 << 14


def needed(n: int | np.ndarray, percent: int):
    """ceil(percent / 100 * n)"""
    return -(-percent * n // 100)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle, of none is empty."""
    raw, offsets = kernels.text_bytes(texts)
    starts, ends, first = kernels.words(raw, offsets)
    hashes = kernels.word_hashes(raw, starts, ends, kernels.FOLDED_VALUES)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield np.unique(kernels.grams(hashes[a:b], min(size, b - a))) if b > a else np.zeros(0, np.uint64)


def class_of(found: np.ndarray) -> int:
    """A set's class as a signed 64-bit number; with its size it names the set."""
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def survey(docs: DataFrame, size: int, folder: str) -> tuple[DataFrame, np.ndarray]:
    """(doc, rid, n, c) of each document, and how many shingles fall into each bucket.

    A bucket's rare shingles add much the same to each, so the exact count still tells a shingle of
    some tens of documents from one of a single document where the average bucket has hundreds.
    """
    shift = np.uint64(64 - SKETCH_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int32)
        for whole in batches:
            for batch in spans.slices(whole, "text"):
                n, c = [], []
                for found in shingle_sets(batch["text"], size):
                    n.append(len(found))
                    c.append(class_of(found))
                    at, times = np.unique((found >> shift).astype(np.int64), return_counts=True)
                    counts[at] += times.astype(np.int32)
                none = pa.nulls(len(n), pa.binary())
                yield pa.RecordBatch.from_arrays([batch["doc"], batch["rid"], pa.array(n, pa.int32()), pa.array(c, pa.int64()), none], names=["doc", "rid", "n", "c", "part"])
        if counts.any():
            parts = [x.tobytes() for x in np.split(counts, SKETCH_PARTS)]
            zero = pa.array([0] * SKETCH_PARTS, pa.int64())
            yield pa.RecordBatch.from_arrays([zero, zero, pa.array([-1] * SKETCH_PARTS, pa.int32()), pa.array(range(SKETCH_PARTS), pa.int64()), pa.array(parts, pa.binary())], names=["doc", "rid", "n", "c", "part"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << SKETCH_BITS) // SKETCH_PARTS, np.int64)
        for batch in batches:
            for x in batch["part"]:
                total += np.frombuffer(x.as_buffer(), np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["c", "total"])

    both = materialize(docs.select("doc", "rid", "text").mapInArrow(run, "doc long, rid long, n int, c long, part binary"), f"{folder}/survey")
    rows = both.filter("n < 0").select("c", "part").groupBy("c").applyInArrow(add, "c long, total binary").collect()
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in rows:  # always SKETCH_PARTS rows, eight bytes a bucket
        part = len(counts) // SKETCH_PARTS
        counts[row.c * part : (row.c + 1) * part] = np.frombuffer(row.total, np.int64)
    return both.filter("n >= 0").select("doc", "rid", "n", "c"), counts.clip(max=(1 << 32) - 1).astype(np.uint32)


def blocks(docs: DataFrame, counts: np.ndarray, size: int, percent: int, folder: str) -> DataFrame:
    """(block, c, n): which classes meet in a prefix list, under the smallest class of the list."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    shift = np.uint64(64 - SKETCH_BITS)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for batch in spans.slices(whole, "text"):
                h, n, c = [], [], []
                for found in shingle_sets(batch["text"], size):
                    own = class_of(found)
                    if not len(found) or own in seen:  # copies within this task add nothing
                        continue
                    seen.add(own)
                    order = np.lexsort((found, shared.value[(found >> shift).astype(np.int64)]))
                    h.append(found[order[: len(found) - needed(len(found), percent) + 1]] >> LIST_SHIFT)
                    n.append(np.full(len(h[-1]), len(found), np.int32))
                    c.append(np.full(len(h[-1]), own))
                if h:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h).view(np.int64)), pa.array(np.concatenate(n)), pa.array(np.concatenate(c))], names=["h", "n", "c"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the list that may go on in the next batch: shingle, first class and its size
        for batch in batches:
            if not batch.num_rows:
                continue
            h, c, n = (batch[x].to_numpy() for x in ("h", "c", "n"))
            begin = np.concatenate([[0], np.flatnonzero(h[1:] != h[:-1]) + 1])
            first, first_n = c[begin].copy(), n[begin].copy()
            if last is not None and last[0] == h[0]:
                first[0], first_n[0] = last[1], last[2]
            length = np.diff(np.append(begin, len(h)))
            last = (h[-1], first[-1], first_n[-1])
            block, block_n = np.repeat(first, length), np.repeat(first_n, length)
            met = (c != block) | (n != block_n)
            met[1:] &= (h[1:] != h[:-1]) | (c[1:] != c[:-1]) | (n[1:] != n[:-1])  # once a list
            shared = np.add.reduceat(met, begin) > 0
            rows = np.vstack([np.column_stack([block, c, n])[met], np.column_stack([first, first, first_n])[shared]])
            if len(rows):
                rows, times = np.unique(rows, axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(rows[:, 2].astype(np.int32)), pa.array(times)], names=["block", "c", "n", "k"])

    lists = docs.select("text").mapInArrow(prefixes, "h long, n int, c long")
    lists = lists.repartition(F.col("h")).sortWithinPartitions("h", "c", "n")
    met = lists.select("h", "c", "n").mapInArrow(meet, "block long, c long, n int, k long")
    met = materialize(met.groupBy("block", "c", "n").agg(F.sum("k").alias("k")), f"{folder}/met")
    # Sets of sizes n <= s that share m prefix n-grams overlap in m + needed(s) - 1 at most, as what
    # stands behind the prefix of one can't all be shared; and m is at most the lists t that a class
    # shares with any other. Who has no size in its block for which t could reach that goes.
    # Nor need a linked pair meet in every block: a class leaves its blocks with the fewest lists as
    # long as those hold under half of what a link there takes in all. What either side leaves is then
    # less than what both share, so they still meet in some block.
    lists_of = materialize(met.groupBy("c", "n").agg(F.sum("k").alias("t")), f"{folder}/shared_lists")
    sizes = met.groupBy("block", "n").agg(F.count("*").alias("m")).groupBy("block").agg(F.collect_list(F.struct(F.col("n").alias("s"), "m")).alias("sizes"))
    sizes = materialize(sizes, f"{folder}/sizes")
    ratio = f"100 * least(n, x.s) >= {percent} * greatest(n, x.s)"
    least = f"({percent} * (n + x.s) + {99 + percent}) div {100 + percent} - ({percent} * greatest(n, x.s) + 99) div 100 + 1"
    fits = f"{ratio} AND {least} <= t AND (x.s <> n OR x.m > 1)"
    takes = F.expr(f"array_min(transform(filter(sizes, x -> {fits}), x -> {least}))")  # null: nothing fits
    fewest = Window.partitionBy("c", "n").orderBy("k", "block").rowsBetween(Window.unboundedPreceding, 0)
    able = met.join(lists_of.hint("merge"), ["c", "n"]).join(sizes.hint("merge"), "block")
    able = able.select("block", "c", "n", "k", takes.alias("takes")).filter("takes IS NOT NULL")
    able = able.withColumn("left", F.sum("k").over(fewest)).filter("2 * left >= takes").select("block", "c", "n")
    able = materialize(able, f"{folder}/able")
    several = materialize(able.groupBy("block").count().filter("count > 1").select("block"), f"{folder}/several")
    return able.join(several.hint("merge"), "block", "left_semi")


def only(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The documents that members name, and few others, by a filter of fixed size instead of a shuffle of all texts."""
    slot = F.expr(f"pmod(xxhash64(doc, rid), {1 << FILTER_BITS}L)")
    number, place = F.expr("bitmap_bucket_number(_slot)"), F.expr("bitmap_bit_position(_slot)")
    bits = members.select(slot.alias("_slot")).groupBy(number.alias("_number")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_slot))").alias("_bits"))
    known = docs.withColumn("_slot", slot).withColumn("_number", number).withColumn("_place", place)
    # A bucket is 4 KB for 32,768 bits, so the broadcast has 1 << FILTER_BITS bits at most.
    byte = "CAST(conv(hex(substring(_bits, CAST(_place div 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    return known.join(F.broadcast(bits), "_number").filter(f"shiftright({byte}, CAST(_place % 8 AS INT)) % 2 = 1").select(docs.columns)


def incidence_slices(sets: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each SLICE of the n-grams that two sets have: rows of bits, and how many of each set's n-grams are still to come."""
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, inverse, times = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True)
    place = np.cumsum(times > 1) - 1
    used = times[inverse] > 1
    row, column = row[used], place[inverse[used]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    rest = np.bincount(row, minlength=len(sets))
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, SLICE):
        a, b = np.searchsorted(column, [lo, lo + SLICE])
        bits = np.zeros((len(sets), SLICE // 8), np.uint8)
        at = column[a:b] - lo
        np.bitwise_or.at(bits, (row[a:b], at >> 3), (1 << (at & 7)).astype(np.uint8))
        rest = rest - np.bincount(row[a:b], minlength=len(sets))
        yield bits.view(np.uint64)[:, : -(-(int(at[-1]) + 1) // 64)], rest


def links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows with 100 * intersection >= percent * union; right None: pairs i < j of one side, by size."""
    n = np.array([len(x) for x in left], np.int64)
    m = n if right is None else np.array([len(x) for x in right], np.int64)
    by_n, by_m = np.argsort(n, kind="stable"), np.argsort(m, kind="stable")
    n, m = n[by_n], m[by_m]
    # Of each row the columns whose size allows it, as one range.
    first = np.searchsorted(m, needed(n, percent))
    last = np.searchsorted(m, 100 * n // percent, "right")
    if right is None:
        first = np.maximum(first, np.arange(len(n)) + 1)
    shared = [np.zeros(max(0, b - a), np.int32) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
    sets = [left[i] for i in by_n] + ([] if right is None else [right[j] for j in by_m])
    todo = np.flatnonzero(last > first).tolist()
    for bits, rest in incidence_slices(sets):
        mine, other, ahead = bits[: len(n)], bits[-len(m) :], rest[-len(m) :]
        still = []
        for i in todo:
            a, b = int(first[i]), int(last[i])
            if mine[i].any():
                shared[i] += np.bitwise_count(mine[i] & other[a:b]).sum(axis=1, dtype=np.int32)
            reach = np.flatnonzero((100 + percent) * (shared[i] + np.minimum(rest[i], ahead[a:b])) >= percent * (n[i] + m[a:b]))
            if len(reach):  # columns at both ends that can't link go
                first[i], last[i], shared[i] = a + reach[0], a + reach[-1] + 1, shared[i][reach[0] : reach[-1] + 1]
                still.append(i)
        todo = still
    found = [(i, first[i] + np.flatnonzero((100 + percent) * shared[i].astype(np.int64) >= percent * (n[i] + m[first[i] : last[i]]))) for i in todo]
    a = np.concatenate([np.full(len(j), i) for i, j in found] or [np.zeros(0, np.int64)]).astype(np.int64)
    b = np.concatenate([j for _, j in found] or [np.zeros(0, np.int64)]).astype(np.int64)
    return by_n[a], by_m[b]


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """(root, node) of the components of the links."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [(find(x), x) for x in parent if find(x) != x]


def multiply(docs: DataFrame, members: DataFrame, size: int, percent: int, block_rows: int, folder: str) -> DataFrame:
    """(a, b): links between classes, a forest of each block. members: block, c, n, doc, rid."""
    # A block of many or of long sets is a grid of parts.
    parts = F.ceil(F.greatest(F.count("*") / block_rows, F.sum("n") / PART_SHINGLES)).cast("int")
    sizes = materialize(members.groupBy("block").agg(F.count("*").alias("m"), parts.alias("parts")), f"{folder}/parts")
    spread = join_keyed(members, sizes, ["block"], "m").withColumn("part", F.expr("CAST(pmod(xxhash64(c, n), parts) AS INT)"))

    def incidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in spans.slices(whole, "text"):
                out: dict[str, list] = {x: [] for x in ("block", "i", "j", "part", "n", "c", "grams")}
                for found, rows in zip(shingle_sets(batch["text"], size), batch["rows"].to_pylist(), strict=True):
                    content = found.tobytes()
                    for row in rows:
                        # A block of several parts is multiplied part by part: part i with part j >= i.
                        for other in range(row["parts"]):
                            i, j = sorted((row["part"], other))
                            for name, x in (("block", row["block"]), ("i", i), ("j", j), ("part", row["part"]), ("n", row["n"]), ("c", row["c"]), ("grams", content)):
                                out[name].append(x)
                kinds = {"i": pa.int32(), "j": pa.int32(), "part": pa.int32(), "n": pa.int32(), "grams": pa.binary()}
                yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()})

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list[tuple]) -> pa.RecordBatch:
            _, i, j = rows[0][:3]
            sides = [[x for x in rows if x[3] == p] for p in ((i,) if i == j else (i, j))]
            sets = [[np.frombuffer(x[5], np.uint64) for x in side] for side in sides]
            a, b = links(sets[0], sets[1] if i != j else None, percent)
            names = [np.array([x[4] for x in side], np.int64) for side in sides]
            found = forest(names[0][a], names[-1][b])
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        held: list[tuple] = []
        for batch in batches:
            rows = zip(*(batch[x].to_pylist() for x in ("block", "i", "j", "part", "c", "grams")), strict=True)
            for row in rows:
                if held and held[0][:3] != row[:3]:
                    yield done(held)
                    held = []
                held.append(row)
        if held:
            yield done(held)

    rows = spans.with_text(only(docs.select("doc", "rid", "text"), members), spread, ["block", "c", "n", "part", "parts"]).mapInArrow(incidence, "block long, i int, j int, part int, n int, c long, grams binary")
    rows = rows.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "part", "n", "c")
    return rows.select("block", "i", "j", "part", "c", "grams").mapInArrow(product, "a long, b long")


def ngram_join(docs: DataFrame, folder: str, size: int = SHINGLE, percent: int = PERCENT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, rid (xxhash64 of the text), and
    first_rid (rid of the component's first row, by doc_id and rid).

    Words are split at ASCII white space, A-Z as a-z. Two documents link if 100 * intersection >=
    percent * union of their sets of `size`-word shingles; component_id is the smallest doc_id
    reachable by links. A text with fewer words is one shingle; null, empty and blank texts have
    none and link with nothing. Rows that repeat a doc_id link like any others; a null doc_id ranks
    after all others, and ids may be of any type that has an order. Columns other than doc_id and text are ignored.
    """
    own, ids = spans.keyed(docs, folder)
    keys, counts = survey(own, size, folder)
    classes = materialize(keys.filter("n > 0").groupBy("c", "n").agg(F.min(F.struct("doc", "rid")).alias("first"), F.count("*").alias("copies")), f"{folder}/classes")
    members = blocks(own, counts, size, percent, folder).join(classes.select("c", "n", "first.*").hint("merge"), ["c", "n"])
    members = materialize(members, f"{folder}/members")
    release_shuffles(docs.sparkSession)
    release_memory()
    edges = materialize(multiply(own, members, size, percent, block_rows, folder), f"{folder}/links")
    roots = components(edges, folder).withColumnRenamed("node", "c")
    placed = classes.join(roots.hint("merge"), "c", "left").select("c", "n", "copies", "first", F.coalesce("root", "c").alias("root"))
    placed = materialize(placed, f"{folder}/placed")
    least = placed.groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("m")).selectExpr("root", "m", "least.doc AS component", "least.rid AS first_rid")
    named = join_keyed(placed, materialize(least, f"{folder}/least"), ["root"], "m")
    named = materialize(named.select("c", "n", "copies", "component", "first_rid"), f"{folder}/components")
    joined = join_keyed(keys.filter("n > 0"), named, ["c", "n"], "copies")
    result = joined.unionByName(keys.filter("n = 0").withColumns({"component": F.col("doc"), "first_rid": F.col("rid")}))
    n = F.col("n").cast("long").alias("n_shingles")
    if ids is None:
        kind = dict(docs.dtypes)["doc_id"]
        id_of = lambda x: F.when(F.col(x) < spans.LAST_ID, F.col(x)).cast(kind)
        return result.select(id_of("doc").alias("doc_id"), n, id_of("component").alias("component_id"), "rid", "first_rid")
    named = result.join(ids.hint("merge"), "doc", "left").join(ids.selectExpr("doc_id AS component_id", "doc AS component").hint("merge"), "component", "left")
    return named.select("doc_id", n, "component_id", "rid", "first_rid")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"), work_dir(spark)).drop("rid", "first_rid")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + 4], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)
), both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
)
SELECT w.doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM w LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)
"""

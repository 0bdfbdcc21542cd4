"""Suffix-array dedup over bytes.

The suffix array is sparse: of all suffixes of a text it holds those that start at a minimizer (a
64-byte gram chosen by content, at least one in every 400-byte window), since equal windows hold
equal minimizers. Minimizers seen once are dropped by a hash aggregate, and equal contexts of a
minimizer count as one entry with its number of places. What is left goes by sampled splitters into
ranges of the suffixes' leading bytes; each bucket sorts its suffixes, and the reversed texts before
them, by multikey quicksort. Common prefixes of neighbours then tell which windows around a minimizer
are equal, for every place of the contexts. A bucket's edge never parts equal leading bytes, so no
window has a neighbour across a boundary, except where a minimizer has so many different contexts that
its bucket would not be bounded: the windows of those are compared by 128 bits of BLAKE2b, spread over
all buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelog.llm import spans
from shapelog.llm.common import join_keyed, materialize, table, work_dir

WINDOW = 400
#: Bytes of a minimizer, and so the leading bytes by which suffixes are dealt out.
K = 64
#: Different contexts of one minimizer that a bucket sorts together; more are compared by digest.
GROUP_LIMIT = 20_000
#: Contexts that are sorted at once, whole groups of them.
SORTED_AT_ONCE = 4_000
#: Ranges this short are finished by comparing whole suffixes.
SHORT = 24


def multikey_quicksort(texts: np.ndarray) -> np.ndarray:
    """The order of fixed-width rows of bytes, by three-way partition on eight-byte characters."""
    width = -(-texts.shape[1] // 8) * 8
    padded = np.zeros((len(texts), width), np.uint8)
    padded[:, : texts.shape[1]] = texts
    chars = padded.view(">u8")
    order = np.arange(len(texts))
    todo = [(0, len(texts), 0)]
    while todo:
        lo, hi, depth = todo.pop()
        if hi - lo < 2 or depth >= chars.shape[1]:
            continue
        own = order[lo:hi]
        if hi - lo <= SHORT:
            rest = padded[own, depth * 8 :]
            order[lo:hi] = own[sorted(range(len(own)), key=lambda i, r=rest: r[i].tobytes())]
            continue
        char = chars[own, depth]
        pivot = np.partition(char[:: max(1, len(char) // 64)], min(len(char), 64) // 2 - 1)[min(len(char), 64) // 2 - 1]
        less, more = char < pivot, char > pivot
        same = ~(less | more)
        a, b = lo + int(less.sum()), hi - int(more.sum())
        order[lo:a], order[a:b], order[b:hi] = own[less], own[same], own[more]
        todo += [(lo, a, depth), (a, b, depth + 1), (b, hi, depth)]
    return order


def common_prefixes(texts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Of each row in order: bytes it shares with the one before it (0 for the first)."""
    out = np.zeros(len(order), np.int32)
    if len(order) > 1:
        differ = texts[order[1:]] != texts[order[:-1]]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), texts.shape[1])
    return out


def padded(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(x[:width].ljust(width, b"\0") for x in parts), np.uint8).reshape(len(parts), width)


def repeated_windows(right: list[bytes], left: list[bytes], n: np.ndarray, off: np.ndarray, count: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which windows over a minimizer occur twice, among contexts of any number of minimizers.

    A context: the bytes from the minimizer on, the bytes before it, its n windows of which the
    first starts off bytes before the minimizer, and how often the whole context occurs. Gives
    maximal runs of repeated windows: index of the context, first offset before the minimizer,
    number of windows.
    """
    m, reach = len(right), window - k
    forward, backward = padded(right, window), padded([x[::-1] for x in left], reach)
    by_right, by_left = multikey_quicksort(forward), multikey_quicksort(backward)
    shared_right, shared_left = common_prefixes(forward, by_right), common_prefixes(backward, by_left)
    rank_right, rank_left = np.empty(m, np.int64), np.empty(m, np.int64)
    rank_right[by_right], rank_left[by_left] = np.arange(m), np.arange(m)
    found = np.zeros((m, reach + 2), np.int8)
    for o in range(int((off - n + 1).min()), int(off.max()) + 1):
        here = np.flatnonzero((off - n < o) & (o <= off))
        if len(here):
            # Suffixes that share at least window-o bytes stand together; so do the texts before them.
            ahead = np.cumsum(shared_right < window - o)[rank_right[here]]
            before = np.cumsum(shared_left < o)[rank_left[here]] if o else 0
            _, inverse = np.unique(ahead * (m + 1) + before, return_inverse=True)
            found[here, o] = np.bincount(inverse, weights=count[here])[inverse] > 1
    edge = np.diff(found, axis=1, prepend=0)
    row, first = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return row, end - 1, end - first


def repeated_spans(docs: DataFrame, folder: str, window: int = WINDOW, k: int = K, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(doc, rid, lo, len): bytes under windows that start at two places at least.

    docs: as `spans.keyed` makes them.
    """
    runs = materialize(spans.runs(docs, spans.byte_tokens, k, window), f"{folder}/runs")
    ends = [F.min("d").alias("d0"), F.max("d").alias("d1"), F.min("e").alias("e0"), F.max("e").alias("e1")]
    shared = runs.groupBy("a").agg(F.count("*").alias("times"), *ends).filter("times > 1").selectExpr("a", "times", "d0 = d1 AND e0 = e1 AS single")
    shared = materialize(shared, f"{folder}/shared")
    cands = materialize(join_keyed(runs, shared, ["a"], "times"), f"{folder}/candidates")
    # A minimizer with one context is one suffix that occurs twice at least: nothing to sort.
    whole = cands.filter("single").selectExpr("doc", "rid", "lo", f"n + {window - 1} AS len")

    several = cands.filter("NOT single")
    contexts = materialize(
        several.groupBy("a", "d", "e").agg(F.count("*").alias("times"), F.min(F.struct("doc", "rid", "lo", "n", "off")).alias("place")),
        f"{folder}/contexts",
    )
    groups = materialize(contexts.groupBy("a").agg(F.count("*").alias("m"), (F.count("*") > group_limit).alias("wide")), f"{folder}/groups")
    places = join_keyed(contexts, groups, ["a"], "m").select("a", "d", "e", "times", "wide", "place.*")

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in spans.slices(whole_batch, "text"):
                rows = batch["rows"]
                count = np.diff(rows.offsets.to_numpy())
                text = np.repeat(np.arange(batch.num_rows), count)
                flat = rows.values.slice(rows.offsets[0].as_py(), int(count.sum()))
                raw = [x.as_py() for x in batch["text"].cast(pa.binary())]
                lo, n, off = (flat.field(x).to_pylist() for x in ("lo", "n", "off"))
                left = [raw[t][x : x + o] for t, x, o in zip(text.tolist(), lo, off, strict=True)]
                right = [raw[t][x + o : x + c + window - 1] for t, x, o, c in zip(text.tolist(), lo, off, n, strict=True)]
                columns = {"lead": pa.array([x[:k] for x in right], pa.binary()), "before": pa.array(left, pa.binary()), "after": pa.array(right, pa.binary())}
                columns |= {x: batch[x].take(pa.array(text)) for x in ("doc", "rid")} | {x: flat.field(x) for x in fields}
                yield pa.RecordBatch.from_pydict(columns)

    schema = "lead binary, before binary, after binary, doc long, rid long, a long, d long, e long, times long, wide boolean, lo int, n int, off int"
    fields = ["a", "d", "e", "times", "wide", "lo", "n", "off"]
    cut = materialize(spans.with_text(docs.select("doc", "rid", "text"), places, fields).mapInArrow(cut_out, schema), f"{folder}/suffixes")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> pa.RecordBatch:
            n, off, times = (table[x].to_numpy().astype(np.int64) for x in ("n", "off", "times"))
            row, first, size = repeated_windows(table["after"].to_pylist(), table["before"].to_pylist(), n, off, times, window, k)
            lo = table["lo"].to_numpy()[row] + off[row] - first
            columns = [table["doc"].to_numpy()[row], table["rid"].to_numpy()[row], lo.astype(np.int32), (size + window - 1).astype(np.int32)]
            columns += [table[x].to_numpy()[row] for x in ("a", "d", "e", "times")] + [table["lo"].to_numpy()[row]]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=[x.split()[0] for x in spots.split(", ")])

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= SORTED_AT_ONCE:
                table = pa.Table.from_batches(held)
                a = table["a"].to_numpy()
                new = np.flatnonzero(a[1:] != a[:-1])
                if len(new):  # the last group may go on
                    yield flush(table.slice(0, int(new[-1]) + 1))
                    held = table.slice(int(new[-1]) + 1).to_batches()
        if held:
            yield flush(pa.Table.from_batches(held))

    spots = "doc long, rid long, lo int, len int, a long, d long, e long, times long, base int"
    # Ranges of the leading bytes, by splitters sampled from them; a group's suffixes follow each other.
    dealt = cut.filter("NOT wide").repartitionByRange("lead").sortWithinPartitions("lead", "a")
    decided = dealt.select("a", "d", "e", "times", "doc", "rid", "lo", "n", "off", "before", "after").mapInArrow(compare, spots)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "rid", "times", "a", "d", "e", "lo"]
        for batch in batches:
            for before, after, n, *rest in zip(*(batch[x].to_pylist() for x in ("before", "after", "n", *names)), strict=True):
                text = memoryview(before + after)
                both = b"".join([blake2b(text[j : j + window], digest_size=16).digest() for j in range(n)])
                halves = np.frombuffer(both, np.int64).reshape(-1, 2)
                *keys, lo = rest
                columns = [halves[:, 0], halves[:, 1], *(np.full(n, x, np.int64) for x in keys), np.arange(lo, lo + n, dtype=np.int32), np.full(n, lo, np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["w0", "w1", *names[:-1], "lo", "base"]).select(order)

    order = ["w0", "w1", "doc", "rid", "times", "lo", "a", "d", "e", "base"]
    wide = cut.filter("wide").mapInArrow(windows, "w0 long, w1 long, doc long, rid long, times long, lo int, a long, d long, e long, base int")
    if not groups.filter("wide").isEmpty():
        wide = materialize(wide, f"{folder}/windows")
        twice = wide.groupBy("w0", "w1").agg(F.sum("times").alias("all_times"), F.count("*").alias("m")).filter("all_times > 1").select("w0", "w1", "m")
        twice = materialize(twice, f"{folder}/twice")
        far = join_keyed(wide, twice, ["w0", "w1"], "m", "left_semi").selectExpr("doc", "rid", "lo", f"{window} AS len", "a", "d", "e", "times", "base")
        decided = decided.unionByName(far)
    decided = materialize(decided, f"{folder}/decided")
    once = decided.filter("times = 1").select("doc", "rid", "lo", "len")
    # What was decided for a context holds at each of its places.
    parts = decided.filter("times > 1").groupBy("a", "d", "e").agg(F.collect_list(F.expr("struct(lo - base AS at, len)")).alias("parts"), F.first("times").alias("times"))
    parts = materialize(parts, f"{folder}/parts")
    again = join_keyed(several.select("a", "d", "e", "doc", "rid", "lo"), parts, ["a", "d", "e"], "times")
    again = again.selectExpr("doc", "rid", "lo", "inline(parts)").selectExpr("doc", "rid", "lo + at AS lo", "len")
    return whole.unionByName(once).unionByName(again)


def suffix_dedup(docs: DataFrame, folder: str, window: int = WINDOW, k: int = K, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the bytes left, in order).

    A byte goes if a string of `window` bytes over it also starts anywhere else in the table. Null
    and empty texts have no bytes; texts under `window` bytes lose nothing. Rows that repeat a
    doc_id with another text are texts of their own; a row repeated as a whole holds the same
    strings at another place, so both lose them. A cut may fall inside a character: `kept` is binary.
    Columns other than doc_id and text are ignored.
    """
    own, _ = spans.keyed(docs, folder)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, runs, texts = [], [], [], []
            for text, drop in zip(batch["text"].cast(pa.binary()), spans.covered(batch["rows"]), strict=True):
                text, at, parts = text.as_py(), 0, []
                for lo, hi in drop.tolist():
                    parts.append(text[at:lo])
                    at = hi
                texts.append(b"".join([*parts, text[at:]]))
                sizes.append(len(text))
                gone.append(len(text) - len(texts[-1]))
                runs.append(len(drop))
            columns = [batch["doc_id"], *(pa.array(x, pa.int64()) for x in (sizes, gone, runs)), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    found = repeated_spans(own, folder, window, k, group_limit)
    kind = dict(docs.dtypes)["doc_id"]
    with_spans = spans.with_text(own, found, ["lo", "len"], "left").select("doc_id", "text", "rows")
    return with_spans.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents"), work_dir(spark))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

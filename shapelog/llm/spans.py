"""Finding repeated windows: runs of windows with a common minimizer, and removal of covered positions.

A window is `window` consecutive tokens. Each window belongs to the minimizer (a k-gram of it) that
its content selects, so equal windows meet under equal minimizers. Consecutive windows with the same
minimizer form one run ("super-k-mer"); a text of n tokens gives some 2n/(window-k) runs, and
only the runs travel, not the windows. A run carries 128 bits of BLAKE2b of its own bytes: equal digests
are what calls two runs equal, wherever they stand; the minimizer's hash only brings them together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapelog.llm import kernels
from shapelog.llm.common import materialize

#: Bytes of text handled at once (a longer text goes alone).
BATCH_BYTES = 4 << 20

RUNS = "a long, d long, e long, doc long, rid long, lo int, n int, off int"
#: What a null doc_id counts as: after all others.
LAST_ID = (1 << 63) - 1
LOW = (1 << 64) - 1


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with some BATCH_BYTES of text each."""
    _, offsets = kernels.text_bytes(batch[column])
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BATCH_BYTES, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


class Tokens(NamedTuple):
    """Tokens of a batch of texts: hashed values, each text's first (one more than texts), and their bytes."""

    values: np.ndarray
    limits: np.ndarray
    view: memoryview
    begin: np.ndarray | None
    end: np.ndarray | None

    def digests(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """BLAKE2b of tokens lo to hi (not included; at least one), words joined by one space: two halves of 64 bits."""
        if not len(lo):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.begin is not None:
            lo, hi = self.begin[lo], self.end[hi - 1]
        view = self.view
        both = b"".join([blake2b(view[x:y], digest_size=16).digest() for x, y in zip(lo.tolist(), hi.tolist(), strict=True)])
        halves = np.frombuffer(both, np.int64).reshape(-1, 2)
        return halves[:, 0], halves[:, 1]


def word_tokens(raw: np.ndarray, offsets: np.ndarray) -> Tokens:
    starts, ends, first = kernels.words(raw, offsets)
    content, begin, end = kernels.joined(raw, starts, ends)
    return Tokens(kernels.word_hashes(content, begin, end), first, memoryview(content), begin, end)


def byte_tokens(raw: np.ndarray, offsets: np.ndarray) -> Tokens:
    return Tokens(raw, offsets, memoryview(np.ascontiguousarray(raw)), None, None)


def window_runs(tokens: np.ndarray, limits: np.ndarray, k: int, window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of all texts at once: minimizer hash, its position, first window and number of windows of each run."""
    valid = np.ones(len(tokens), bool)
    for lo, hi in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
        valid[max(lo, hi - window + 1) : hi] = False  # a window from here would leave the text
    for b in range(0, len(tokens), kernels.SEGMENT):
        part = tokens[b : b + kernels.SEGMENT + window - 1]
        starts = np.flatnonzero(valid[b : b + kernels.SEGMENT])
        if not len(starts):
            continue
        hashes = kernels.grams(kernels.BYTE_VALUES[part] if part.dtype == np.uint8 else part, k)
        keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        owner = (kernels.sliding_min(keys, window - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)[starts]
        cut = np.flatnonzero((np.diff(owner) != 0) | (np.diff(starts) != 1)) + 1
        first = np.concatenate([[0], cut])
        yield hashes[owner[first]], owner[first] + b, starts[first] + b, np.diff(np.concatenate([first, [len(starts)]]))


def runs(docs: DataFrame, tokenize: Callable, k: int, window: int) -> DataFrame:
    """One row per run of windows: minimizer hash a, digest d and e of the run's whole content, place.

    docs: doc, rid (what tells texts of one doc apart) and text.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                tokens = tokenize(*kernels.text_bytes(batch["text"]))
                doc, rid, limits = batch["doc"].to_numpy(), batch["rid"].to_numpy(), tokens.limits
                for a, at, lo, n in window_runs(tokens.values, limits, k, window):
                    d, e = tokens.digests(lo, lo + n + window - 1)
                    text = np.searchsorted(limits, lo, "right") - 1
                    columns = [a.view(np.int64), d, e, doc[text], rid[text], (lo - limits[text]).astype(np.int32), n.astype(np.int32), (at - lo).astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=[x.split()[0] for x in RUNS.split(", ")])

    return docs.select("doc", "rid", "text").mapInArrow(emit, RUNS)


def keyed(docs: DataFrame, folder: str) -> tuple[DataFrame, DataFrame | None]:
    """doc_id, text, doc and rid of each row, and which doc_id a doc stands for, where it isn't that number itself.

    doc is a whole number in the order of doc_id, null as the last; rid tells texts that share a doc_id
    apart. Ids that are no whole numbers are numbered in their order, by sampled ranges. The number
    2**63 - 1 is what null counts as.
    """
    rid, text = F.xxhash64(F.coalesce("text", F.lit(""))).alias("rid"), F.coalesce("text", F.lit("")).alias("text")
    if dict(docs.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint"):
        return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), rid, text), None
    ids = docs.select("doc_id").dropna().distinct().repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ids = materialize(ids.withColumn("doc", F.monotonically_increasing_id()), f"{folder}/ids")
    return docs.select("doc_id", "text").join(ids, "doc_id", "left").select("doc_id", F.coalesce("doc", F.lit(LAST_ID)).alias("doc"), rid, text), ids


def with_text(docs: DataFrame, rows: DataFrame, fields: list[str], how: str = "inner") -> DataFrame:
    """The texts with the array `rows` of all that is known of them (places within one text, so bounded by it)."""
    grouped = rows.groupBy("doc", "rid").agg(F.collect_list(F.struct(*fields)).alias("rows"))
    return docs.join(grouped.hint("shuffle_hash"), ["doc", "rid"], how)


def covered(column: pa.Array) -> list[np.ndarray]:
    """Of each row of a list of (lo, len): the maximal covered runs, as sorted rows of start and end."""
    if not len(column):
        return []
    offsets = column.offsets.to_numpy()
    lo, size = (column.values.field(x).to_numpy(zero_copy_only=False) for x in ("lo", "len"))
    known = column.is_valid().to_numpy(zero_copy_only=False)
    none = np.zeros((0, 2), np.int64)
    out = []
    for i in range(len(column)):
        a, b = offsets[i], offsets[i + 1]
        if not known[i] or a == b:
            out.append(none)
            continue
        s, e = lo[a:b].astype(np.int64), lo[a:b].astype(np.int64) + size[a:b]
        order = np.argsort(s, kind="stable")
        s, e = s[order], np.maximum.accumulate(e[order])
        new = np.flatnonzero(s[1:] > e[:-1]) + 1
        out.append(np.column_stack([s[np.concatenate([[0], new])], e[np.concatenate([new - 1, [len(e) - 1]])]]))
    return out

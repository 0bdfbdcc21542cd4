"""Toxicity by a factorization machine over hashed terms.

A term is a word, or the first four or five bytes of a longer one (stems that take many endings);
each is hashed to one of 2**BITS buckets. score = sigmoid(w0 + sum w_i + sum over pairs <v_i, v_j>)
over the terms present, so a pair such as an insult with the mention of a group can weigh more than
its parts. Training is by sparse mini-batches in two rounds: first over the terms that show a sign
alone, then, from there on, over every term of the sample, so that a pair of terms that are neutral
alone is learned too. Part of the sample only judges: the weights after the round and pass that did
best on it are taken, which keeps chance signs of neutral terms out, and long clean texts clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shapelog.llm import kernels, spans
from shapelog.llm.common import release_memory, table

BITS = 20
PREFIXES = (4, 5)
#: At most so many labelled rows train the model: those with the smallest hash of their doc_id.
TRAIN_ROWS = 12_000
#: And at most so many distinct terms of them, all in all.
TRAIN_TERMS = 1 << 25
#: Documents of the sample that a term must be in.
LEAST_DOCUMENTS = 3
#: Standard errors by which the odds of a term must differ from those of all rows to be in the first round.
SURE = 3
FACTORS = 4
#: Passes over the sample in each round, and rows of a mini-batch.
EPOCHS = (40, 100)
BATCH = 256
#: A round ends after so many passes without a gain on the judging rows.
PATIENCE = 40
#: One of so many rows of the sample judges.
JUDGES = 10


def terms(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every term; ASCII letters are folded to lower case."""
    starts, ends, first = kernels.words(raw, offsets, kernels.WORD_BYTES)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    size = ends - starts
    found, of = [kernels.word_hashes(raw, starts, ends, kernels.FOLDED_VALUES)], [text]
    values = kernels.FOLDED_VALUES[raw]
    for n in PREFIXES:
        longer = size > n
        at = starts[longer]
        h = np.full(len(at), np.uint64(n))
        for j in range(n):
            h = kernels.mix(h * kernels.STEPS[n] + values[at + j])
        found.append(h)
        of.append(text[longer])
    return (kernels.mix(np.concatenate(found)) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(of)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Machine:
    """w0, and w and v of every bucket (0 where a bucket has no weight)."""

    w0: float
    w: np.ndarray
    v: np.ndarray

    def logits(self, buckets: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        """Of n texts whose distinct buckets are given with the text of each."""
        out = self.w0 + np.bincount(text, self.w[buckets], n)
        for f in range(self.v.shape[1]):
            v = self.v[buckets, f]
            out += 0.5 * (np.bincount(text, v, n) ** 2 - np.bincount(text, v * v, n))
        return out


def gradients(w: np.ndarray, v: np.ndarray, w0: float, at: np.ndarray, row: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Of the mean log loss by w0, w and v, where term at[i] is in row[i] of the batch."""
    n = len(labels)
    sums = np.stack([np.bincount(row, v[at, f], n) for f in range(v.shape[1])], axis=1)
    out = w0 + np.bincount(row, w[at], n) + 0.5 * ((sums**2).sum(axis=1) - np.bincount(row, (v**2).sum(axis=1)[at], n))
    error = (sigmoid(out) - labels) / n
    by_w = np.bincount(at, error[row], len(w))
    by_v = np.stack([np.bincount(at, (error[:, None] * sums)[row, f], len(w)) for f in range(v.shape[1])], axis=1) - by_w[:, None] * v
    return float(error.sum()), by_w, by_v


def batch_of(rows: list[np.ndarray], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms of the chosen rows, and the place among them of the row of each."""
    part = [rows[i] for i in chosen]
    return np.concatenate([*part, np.zeros(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(part)), [len(x) for x in part])


def rounds(machine: Machine, rows: list[np.ndarray], labels: np.ndarray, learn: np.ndarray, judge: np.ndarray, epochs: int, rate: float, rng: np.random.Generator) -> Machine:
    """AdaGrad over sparse mini-batches; the weights, after whichever pass, of the least loss on the judging rows."""

    def loss(m: Machine) -> float:
        z = m.logits(*batch_of(rows, judge), len(judge))
        return float(np.mean(np.logaddexp(0, z) - labels[judge] * z))

    best, least, since = machine, loss(machine), 0
    w0, w, v = machine.w0, machine.w.copy(), machine.v.copy()
    past0, past_w, past_v = 1e-4, np.full(len(w), 1e-4), np.full(len(w), 1e-4)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(learn)
        for i in range(0, len(order), BATCH):
            chosen = order[i : i + BATCH]
            flat, row = batch_of(rows, chosen)
            used, at = np.unique(flat, return_inverse=True)
            own_w, own_v = w[used], v[used]
            g0, gw, gv = gradients(own_w, own_v, w0, at, row, labels[chosen])
            gw, gv = gw + 1e-4 * own_w, gv + 1e-4 * own_v
            past0 += g0 * g0
            past_w[used] += gw * gw
            past_v[used] += (gv**2).mean(axis=1)
            w0 -= step * g0 / np.sqrt(past0)
            w[used] = own_w - step * gw / np.sqrt(past_w[used])
            v[used] = own_v - step * gv / np.sqrt(past_v[used])[:, None]
        now = Machine(w0, w.copy(), v.copy())
        if (found := loss(now)) < least:
            best, least, since = now, found, 0
        elif (since := since + 1) >= PATIENCE:
            break
    return best


def train(rows: list[np.ndarray], labels: np.ndarray, seed: int = 0, epochs: tuple[int, int] = EPOCHS) -> Machine:
    """Fit on the distinct buckets of each row. Without rows of both labels it scores all alike."""
    n, positives = len(rows), int(labels.sum())
    base = float(np.log((positives + 0.5) / (n - positives + 0.5)))
    none = Machine(base, np.zeros(1 << BITS), np.zeros((1 << BITS, FACTORS)))
    if not positives or positives == n:
        return none
    total, toxic = np.zeros(1 << BITS, np.int32), np.zeros(1 << BITS, np.int32)
    for row, label in zip(rows, labels, strict=True):  # a row's buckets are distinct
        total[row] += 1
        toxic[row] += label > 0
    # The term's sign: how surely its odds differ from those of all rows, in standard errors.
    known = np.flatnonzero(total >= LEAST_DOCUMENTS)
    total, toxic = total[known], toxic[known]
    odds = np.log((toxic + 0.5) / (total - toxic + 0.5)) - base
    sure = np.abs(odds) / np.sqrt(1 / (toxic + 0.5) + 1 / (total - toxic + 0.5))
    rng = np.random.default_rng(seed)
    judge = np.sort(rng.permutation(n)[: n // JUDGES])
    learn = np.setdiff1d(np.arange(n), judge)
    if n < JUDGES**2:  # too few to set any aside
        judge = learn = np.arange(n)
    place = np.full(1 << BITS, -1, np.int32)
    machine = Machine(base, np.zeros(len(known)), rng.normal(0, 0.01, (len(known), FACTORS)))
    start = machine.v.copy()
    for chosen, passes, rate in ((known[sure > SURE], epochs[0], 0.1), (known, epochs[1], 0.1)):
        place[:] = -1
        place[chosen] = np.searchsorted(known, chosen)
        own = [p[p >= 0] for p in (place[row] for row in rows)]
        machine = rounds(machine, own, labels, learn, judge, passes, rate, rng)
    w, v = none.w, none.v
    moved = (machine.w != 0) | (machine.v != start).any(axis=1)  # what never learned has no weight
    w[known[moved]], v[known[moved]] = machine.w[moved], machine.v[moved]
    return Machine(machine.w0, w, v)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(text, label) of the sample: at most `limit` labelled rows, so their ids may be broadcast."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna().groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def within(sample: DataFrame, size: Column, limit: int) -> DataFrame:
    """The rows of a sample, in the order it was chosen, up to a total size: what comes to the driver."""
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # of a bounded number of rows
    return sample.withColumn("total_size", F.sum(size).over(before)).filter(F.col("total_size") <= limit).drop("total_size")


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Machine:
    """Learn from the labelled documents, of which at most `limit` count.

    Only the distinct hashed terms of the sample come to the driver, TRAIN_TERMS of four bytes at most. Rows without a label or with a null doc_id don't count; of a doc_id with two labels the larger
    one does; a text that repeats a doc_id is a row of its own. Null and empty texts have no terms.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in spans.slices(whole, "text"):
                buckets, text = terms(*kernels.text_bytes(batch["text"]))
                pairs = np.unique(text << BITS | buckets)
                ends = np.searchsorted(pairs >> BITS, np.arange(batch.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((pairs & ((1 << BITS) - 1)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch["doc_id"], lists, batch["label"]], names=["doc_id", "terms", "label"])

    rows = training_rows(docs, labels, "toxic", limit)
    kind = dict(rows.dtypes)["doc_id"]
    sample = rows.mapInArrow(hashed, f"doc_id {kind}, terms array<int>, label int")
    got = within(sample, F.size("terms"), TRAIN_TERMS).toArrow().sort_by("doc_id")
    lists = got["terms"].combine_chunks()
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    machine = train([flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], got["label"].to_numpy())
    del got, lists, ends, flat
    release_memory()
    return machine


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """The table with a column `score`: the probability that the text is toxic.

    Whole texts of any length are read; null and empty texts have no terms and score what the base
    rate gives. All columns stay; one named `score` is replaced.
    """
    # Few terms have weights: only those travel and are looked up.
    active = np.flatnonzero((machine.w != 0) | machine.v.any(axis=1))
    place = np.full(1 << BITS, -1, np.int32)
    place[active] = np.arange(len(active))
    shared = docs.sparkSession.sparkContext.broadcast((place, Machine(machine.w0, machine.w[active], machine.v[active])))
    kept = docs.drop("score")
    names = [*kept.columns, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in spans.slices(whole, "text"):
                buckets, text = terms(*kernels.text_bytes(batch["text"]))
                place, own = shared.value
                at = place[buckets].astype(np.int64)
                pairs = np.unique((text << BITS | at)[at >= 0])  # presence, not counts
                p = sigmoid(own.logits(pairs & ((1 << BITS) - 1), pairs >> BITS, batch.num_rows))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=names)

    return kept.mapInArrow(run, ", ".join(f"`{x}` {kind}" for x, kind in kept.dtypes) + ", score double")


def held_out(folds: int, fold: int):
    """Whether crc32 of the doc_id as text, modulo folds, is the fold; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == fold


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = fit(docs, labels.filter(~held_out(5, 0)))
    scored = score(docs.select("doc_id", "text"), machine).drop("text")
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", F.expr("CAST(score >= 0.5 AS INT) AS predicted"))

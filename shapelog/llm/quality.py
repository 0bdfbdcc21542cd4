"""Quality by a convolutional network over bytes, in numpy.

Learned filters of TAPS bytes slide over the whole text. Their outputs are max-pooled over blocks
and then over chunks of CHUNK_BLOCKS blocks that overlap by one, so that every byte is in a chunk;
a hidden layer reads each chunk, and the mean and the maximum of the hidden values over all chunks
give one probability. A filter is a table of TAPS x 256 weights, so a convolution is TAPS lookups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelog.llm import kernels, spans
from shapelog.llm.common import release_memory, table
from shapelog.llm.toxicity import held_out, sigmoid, training_rows, within

TAPS, FILTERS, HIDDEN = 5, 8, 12
BLOCK, CHUNK_BLOCKS = 64, 8
#: At most so many labelled rows train the network: those with the smallest hash of their doc_id.
TRAIN_ROWS = 3000
#: And at most so many bytes of their texts.
TRAIN_BYTES = 128 << 20
EPOCHS = 8
#: Bytes convolved at once, and bytes of training texts whose gradients are computed at once (one text at least).
PIECE = 1 << 17

Weights = dict[str, np.ndarray]


def start(seed: int) -> Weights:
    rng = np.random.default_rng(seed)
    w = {"conv": rng.normal(0, 0.25, (TAPS, 256, FILTERS)), "bias": np.zeros(FILTERS)}
    w |= {"in": rng.normal(0, FILTERS**-0.5, (FILTERS, HIDDEN)), "in0": np.zeros(HIDDEN)}
    w |= {"out": rng.normal(0, 0.1, 2 * HIDDEN), "out0": np.zeros(1)}
    return {k: v.astype(np.float32) for k, v in w.items()}


def layout(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts with TAPS zeros after each, the blocks' first bytes and ends, and each text's first block (one more than texts).

    A filter stands at every byte of a text and reads zeros behind it; an empty text is one byte of zeros.
    """
    size = np.diff(offsets)
    blocks = np.maximum(1, -(-size // BLOCK))
    first = np.concatenate([[0], np.cumsum(blocks)])
    at = offsets[:-1] + TAPS * np.arange(len(size))
    buffer = np.zeros(len(raw) + TAPS * (len(size) + 1), np.uint8)
    for a, b, to in zip(offsets[:-1].tolist(), offsets[1:].tolist(), at.tolist(), strict=True):
        buffer[to : to + b - a] = raw[a:b]
    begins = np.repeat(at, blocks) + BLOCK * (np.arange(first[-1]) - np.repeat(first[:-1], blocks))
    return buffer, begins, np.minimum(begins + BLOCK, np.repeat(at + np.maximum(size, 1), blocks)), first


def block_maxima(buffer: np.ndarray, begins: np.ndarray, ends: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """Maximum of each filter over each block."""
    out = np.empty((len(begins), conv.shape[2]), np.float32)
    i = 0
    while i < len(begins):
        j = max(i + 1, int(np.searchsorted(begins, begins[i] + PIECE)))
        lo, hi = begins[i], ends[j - 1] + 1
        total = np.take(conv[0], buffer[lo:hi], axis=0)
        held = np.empty_like(total)
        for t in range(1, TAPS):
            total += np.take(conv[t], buffer[lo + t : hi + t], axis=0, out=held, mode="clip")
        out[i:j] = np.maximum.reduceat(total, np.column_stack([begins[i:j], ends[i:j]]).ravel() - lo, axis=0)[::2]
        i = j
    return out


def chunks(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last block of each chunk, and each text's first chunk (one more than texts)."""
    blocks = np.diff(first)
    step = CHUNK_BLOCKS - 1
    count = np.maximum(1, -(-(blocks - 1) // step))
    own = np.concatenate([[0], np.cumsum(count)])
    begin = np.repeat(first[:-1], count) + step * (np.arange(own[-1]) - np.repeat(own[:-1], count))
    return begin, np.minimum(begin + CHUNK_BLOCKS, np.repeat(first[1:], count)) - 1, own


def pool(maxima: np.ndarray, begin: np.ndarray, last: np.ndarray) -> np.ndarray:
    out = maxima[begin].copy()
    for i in range(1, CHUNK_BLOCKS):
        np.maximum(out, maxima[np.minimum(begin + i, last)], out=out)
    return out


def head(pooled: np.ndarray, own: np.ndarray, w: Weights) -> tuple[np.ndarray, ...]:
    seen = np.maximum(pooled + w["bias"], 0)
    hidden = np.tanh(seen @ w["in"] + w["in0"])
    count = np.diff(own)[:, None]
    mean, most = np.add.reduceat(hidden, own[:-1], axis=0) / count, np.maximum.reduceat(hidden, own[:-1], axis=0)
    return seen, hidden, mean, most, np.hstack([mean, most]) @ w["out"] + w["out0"]


def probabilities(raw: np.ndarray, offsets: np.ndarray, w: Weights) -> np.ndarray:
    """Of each text, from all of its bytes; an empty text is one block of zeros."""
    if len(offsets) < 2:
        return np.zeros(0)
    buffer, begins, ends, first = layout(raw, offsets)
    begin, last, own = chunks(first)
    return sigmoid(head(pool(block_maxima(buffer, begins, ends, w["conv"]), begin, last), own, w)[-1].astype(float))


def gradients(texts: list[bytes], labels: np.ndarray, w: Weights) -> Weights:
    """Of the mean log loss over whole texts, summed over groups of texts that bound memory."""
    ends = np.cumsum([len(x) for x in texts]) // PIECE
    parts = np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends)) + 1)
    found = [_gradients([texts[i] for i in part], labels[part], w, len(texts)) for part in parts]
    return {k: sum(g[k] for g in found) for k in found[0]}


def winners(buffer: np.ndarray, begins: np.ndarray, ends: np.ndarray, blocks: np.ndarray, filters: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """The first byte of each of these blocks at which its filter is largest."""
    out = np.empty(len(blocks), np.int64)
    for i in range(0, len(blocks), PIECE // BLOCK):
        b, f = blocks[i : i + PIECE // BLOCK], filters[i : i + PIECE // BLOCK, None]
        at = begins[b][:, None] + np.arange(BLOCK)
        total = sum(conv[t, buffer[np.minimum(at + t, len(buffer) - 1)], f] for t in range(TAPS))
        total[at >= ends[b][:, None]] = -np.inf
        out[i : i + PIECE // BLOCK] = begins[b] + total.argmax(1)
    return out


def _gradients(texts: list[bytes], labels: np.ndarray, w: Weights, n: int) -> Weights:
    """Of these texts' share of the mean over n. Through the pooling, only the winning position of each chunk and filter counts."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    buffer, begins, ends, first = layout(raw, offsets)
    begin, last, own = chunks(first)
    maxima = block_maxima(buffer, begins, ends, w["conv"])
    pooled = pool(maxima, begin, last)
    seen, hidden, mean, most, out = head(pooled, own, w)
    count = np.diff(own)
    error = (sigmoid(out) - labels).astype(np.float32) / n
    grad = {"out": np.hstack([mean, most]).T @ error, "out0": error.sum(keepdims=True)}
    up = np.repeat(error, count)[:, None] * w["out"]
    to_mean = up[:, :HIDDEN] / np.repeat(count, count)[:, None]
    to_most = up[:, HIDDEN:] * (hidden == np.repeat(most, count, axis=0))
    inner = (to_mean + to_most) * (1 - hidden**2)
    grad |= {"in": seen.T @ inner, "in0": inner.sum(0)}
    back = (inner @ w["in"].T) * (pooled + w["bias"] > 0)
    grad["bias"] = back.sum(0)
    conv = np.zeros_like(w["conv"])
    c, f = np.nonzero(back)
    best = begin[c]
    for i in range(1, CHUNK_BLOCKS):
        other = np.minimum(begin[c] + i, last[c])
        best = np.where(maxima[other, f] > maxima[best, f], other, best)
    at = winners(buffer, begins, ends, best, f, w["conv"])
    for t in range(TAPS):
        np.add.at(conv[t], (buffer[at + t], f), back[c, f])
    grad["conv"] = conv
    return grad


def train(texts: list[bytes], labels: np.ndarray, seed: int = 0, epochs: int = EPOCHS) -> Weights:
    """Fit by Adam. Without rows the network is as it starts."""
    w, rng = start(seed), np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step, batch = 0, 32
    total = epochs * max(1, -(-len(texts) // batch))
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for i in range(0, len(texts), batch):
            step += 1
            part = [texts[j] for j in order[i : i + batch]]
            grad = gradients(part, labels[order[i : i + batch]], w)
            rate = 0.02 * (1 - step / (total + 1))
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                w[k] = (w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return w


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Weights:
    """Learn from the labelled documents; the whole texts of at most `limit` rows and TRAIN_BYTES come to the driver.

    Rows without a label or with a null doc_id don't count; of a doc_id with two labels the larger one
    does; a text that repeats a doc_id is a row of its own. A null text is an empty one.
    """
    sample = training_rows(docs, labels, "quality", limit)
    got = within(sample, F.coalesce(F.octet_length("text"), F.lit(0)), TRAIN_BYTES).toArrow().sort_by("doc_id")
    texts = [(x or "").encode() for x in got["text"].to_pylist()]
    weights = train(texts, got["label"].to_numpy().astype(np.float32))
    del got, texts
    release_memory()
    return weights


def score(docs: DataFrame, weights: Weights) -> DataFrame:
    """The table with a column `score`: the probability that the text is of good quality.

    Whole texts of any length are read; null counts as empty, and an empty text gets a score too.
    All columns stay; one named `score` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kept = docs.drop("score")
    names = [*kept.columns, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in spans.slices(whole, "text"):
                p = probabilities(*kernels.text_bytes(batch["text"]), shared.value)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=names)

    return kept.mapInArrow(run, ", ".join(f"`{x}` {kind}" for x, kind in kept.dtypes) + ", score double")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = fit(docs, labels.filter(~held_out(3, 1)))
    scored = score(docs.select("doc_id", "text"), weights).drop("text")
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", F.expr("CAST(score >= 0.5 AS INT) AS predicted"))

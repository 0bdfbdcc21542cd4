"""Numpy kernels over Arrow string buffers: word boundaries, hashes and window minimizers.

All functions work on the concatenated bytes of a batch of texts, so no Python loop runs per word.
A hash only ever *proposes* that two spans are equal; op6 and op8 compare a cryptographic digest of
the spans' own bytes (see `spans`) before they call them equal. The n-gram join compares shingles by
64 bits and states the chance of an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Positions handled at once; longer texts are cut into overlapping segments.
SEGMENT = 1 << 20
MAX64 = np.uint64(0xFFFFFFFFFFFFFFFF)

_rng = np.random.Generator(np.random.PCG64(20240229))
#: A random odd 64-bit value for each byte; and the same with A-Z folded onto a-z.
BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]
#: Odd multipliers of the doubling steps of `grams`.
STEPS = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes of words hashed at once: the arrays of eight bytes a byte stay small.
HASHED = 1 << 18
#: What a byte's place in its word adds to its value before both are mixed.
PLACE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that words are made of: all but ASCII white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, *range(9, 14)]] = False
#: Digits, letters and all of UTF-8's longer characters.
WORD_BYTES = np.zeros(256, dtype=bool)
WORD_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each (one more than texts); null is empty."""
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    if texts.null_count:
        texts = texts.fill_null("")
    _, off, data = texts.buffers()
    if off is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(off, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(raw: np.ndarray, offsets: np.ndarray, of: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes in `of`, and the first word of each text (one more than texts)."""
    inside = of[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    first[cuts] = inside[cuts]  # a text's edge ends a word
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """A 64-bit hash of each word's bytes that does not depend on where the word stands.

    Byte and place in the word are mixed before they are added up, so no arrangement of bytes cancels
    out whatever the values are, as it does in a polynomial modulo 2**64.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASHED, "right")))
        lo, hi = starts[i], ends[j - 1]
        s, e = starts[i:j] - lo, ends[i:j] - lo
        size = np.diff(s, append=hi - lo)
        place = (np.arange(hi - lo) - np.repeat(s, size)).astype(np.uint64)
        sums = np.empty(hi - lo + 1, np.uint64)
        sums[0] = 0
        np.cumsum(mix(values[raw[lo:hi]] + place * PLACE), out=sums[1:])
        out[i:j] = mix(sums[e] - sums[s] + (e - s).astype(np.uint64) * STEPS[63])
        i = j
    return out


def joined(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space after each, and where each starts and ends there."""
    size = ends - starts
    stops = np.cumsum(size + 1)
    begin = stops - size - 1
    out = np.full(int(stops[-1]) if len(stops) else 0, 32, np.uint8)
    number = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[number + np.repeat(begin, size)] = raw[number + np.repeat(starts, size)]
    return out, begin, begin + size


def grams(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-grams of a sequence of hashed tokens; fewer than k tokens give none."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    have, width, out, at, step = values, 1, None, 0, 0
    while True:  # binary decomposition of k from spans of doubling width
        if k & width:
            part = have[at : at + n]
            out = part if out is None else mix(out * STEPS[step + 32] + part)
            at += width
        if width * 2 > k:
            return out if k > 1 else mix(out)
        have = mix(have[:-width] * STEPS[step] + have[width:])
        width, step = width * 2, step + 1


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    have, width = x, 1
    while width * 2 <= w:
        have = np.minimum(have[:-width], have[width:])
        width *= 2
    rest = w - width
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have

"""Training of the quality network on whole texts."""

import random

import numpy as np
import pytest

from shapelog.llm import quality


def texts():
    r = random.Random(3)
    long = [bytes(r.choice(b"abcdefg \xc3\xa9") for _ in range(n)) for n in (40_000, 20_000, 12_289, 700)]
    return [b"", b"a", *long, b"x" * 64, b"y" * 65, b"z" * 449]


def loss(batch, labels, w):
    raw, ends = np.frombuffer(b"".join(batch), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in batch])])
    p = quality.probabilities(raw, ends, w)
    return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))


@pytest.mark.parametrize("piece", [quality.PIECE, quality.BLOCK])
def test_gradients_of_whole_texts(monkeypatch, piece):
    monkeypatch.setattr(quality, "PIECE", piece)
    batch, rng = texts()[1:], np.random.default_rng(1)
    labels = np.arange(len(batch), dtype=np.float32) % 2
    w = {k: v.astype(np.float64) for k, v in quality.start(2).items()}
    found = quality.gradients(batch, labels, w)
    for k in w:
        d, h = rng.normal(0, 1, w[k].shape), 1e-4
        slope = (loss(batch, labels, w | {k: w[k] + h * d}) - loss(batch, labels, w | {k: w[k] - h * d})) / (2 * h)
        assert abs(float((found[k] * d).sum()) - slope) < 0.05 * abs(slope) + 1e-3, k


def test_training_sees_whole_texts(monkeypatch):
    seen = []
    own = quality.gradients
    monkeypatch.setattr(quality, "gradients", lambda part, labels, w: seen.extend(part) or own(part, labels, w))
    quality.train(texts(), np.arange(len(texts()), dtype=np.float32) % 2, epochs=1)
    assert sorted(seen) == sorted(texts())


def test_a_score_does_not_depend_on_other_texts():
    w = quality.start(3)
    batch = texts()
    raw, ends = np.frombuffer(b"".join(batch), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in batch])])
    alone = [quality.probabilities(np.frombuffer(x, np.uint8), np.array([0, len(x)]), w)[0] for x in batch]
    assert np.allclose(quality.probabilities(raw, ends, w), alone, atol=1e-6)

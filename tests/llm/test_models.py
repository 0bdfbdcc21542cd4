"""The toxicity machine and the quality network against plain Python, numeric gradients, and a label that only a pair decides."""

import math

import numpy as np
from pyspark.sql import functions as F
from test_llm_operators import text

from shapelog.llm import kernels, quality, toxicity


def plain_logit(machine, terms):
    out = machine.w0 + sum(machine.w[i] for i in terms)
    for a, i in enumerate(terms):
        for j in terms[a + 1 :]:
            out += sum(machine.v[i, f] * machine.v[j, f] for f in range(machine.v.shape[1]))
    return out


def test_machine_by_plain_python():
    rng = np.random.default_rng(1)
    machine = toxicity.Machine(-0.5, rng.normal(0, 1, 30), rng.normal(0, 1, (30, 4)))
    rows = [np.unique(rng.integers(0, 30, n)) for n in (0, 1, 2, 7, 25)]
    got = machine.logits(*toxicity.batch_of(rows, np.arange(len(rows))), len(rows))
    assert np.allclose(got, [plain_logit(machine, r.tolist()) for r in rows])


def test_machine_gradients():
    rng = np.random.default_rng(2)
    w0, w, v = 0.3, rng.normal(0, 0.5, 12), rng.normal(0, 0.5, (12, 4))
    rows, labels = [np.unique(rng.integers(0, 12, n)) for n in (1, 3, 5, 8, 2)], np.array([0, 1, 1, 0, 1])
    at, row = toxicity.batch_of(rows, np.arange(5))

    def loss(w0, w, v):
        z = toxicity.Machine(w0, w, v).logits(at, row, 5)
        return np.mean(np.logaddexp(0, z) - labels * z)

    g0, gw, gv = toxicity.gradients(w, v, w0, at, row, labels)
    d0, dw, dv, h = 0.7, rng.normal(0, 1, w.shape), rng.normal(0, 1, v.shape), 1e-5
    slope = (loss(w0 + h * d0, w + h * dw, v + h * dv) - loss(w0 - h * d0, w - h * dw, v - h * dv)) / (2 * h)
    assert abs(g0 * d0 + (gw * dw).sum() + (gv * dv).sum() - slope) < 1e-7


def pairs(n, seed):
    """Toxic if exactly one of terms 7 and 8 is present; neither says anything alone."""
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for _ in range(n):
        a, b = rng.random(2) < 0.5
        rows.append(np.unique([*rng.integers(1000, 1060, 15), *([7] if a else []), *([8] if b else [])]).astype(np.int32))
        labels.append(int(a != b))
    return rows, np.array(labels)


def test_a_label_that_only_a_pair_decides(monkeypatch):
    rows, labels = pairs(4000, 1)
    fresh, truth = pairs(2000, 2)

    def accuracy():
        machine = toxicity.train(rows, labels)
        z = machine.logits(*toxicity.batch_of(fresh, np.arange(len(fresh))), len(fresh))
        return np.mean((z > 0) == truth)

    assert accuracy() >= 0.95
    own = toxicity.gradients
    monkeypatch.setattr(toxicity, "gradients", lambda *x: (*own(*x)[:2], np.zeros_like(x[1])))
    assert accuracy() < 0.65  # a linear machine


def test_terms_by_plain_python():
    raw, offsets = kernels.text_bytes(__import__("pyarrow").array(["Scum scUMbag, scum!", None, "abcde"]))
    buckets, of = toxicity.terms(raw, offsets)
    own = {i: sorted(buckets[of == i].tolist()) for i in range(3)}
    one = lambda t: sorted(toxicity.terms(*kernels.text_bytes(__import__("pyarrow").array([t])))[0].tolist())
    assert own[0] == one("scum SCUMBAG scum") and own[1] == [] and len(own[2]) == 2
    assert len(set(own[0])) == 4  # scum twice, scumbag, and its first four and five bytes


def plain_quality(data, w):
    """One text by loops: every filter at every byte, maxima of blocks and chunks, hidden layer, mean and maximum."""
    padded = data + bytes(quality.TAPS)
    n = max(len(data), 1)
    filtered = [[sum(float(w["conv"][t, padded[p + t], f]) for t in range(quality.TAPS)) for f in range(quality.FILTERS)] for p in range(n)]
    blocks = [[max(filtered[p][f] for p in range(b, min(b + quality.BLOCK, n))) for f in range(quality.FILTERS)] for b in range(0, n, quality.BLOCK)]
    step, hidden = quality.CHUNK_BLOCKS - 1, []
    for c in range(0, max(1, len(blocks) - 1), step):
        chunk = blocks[c : c + quality.CHUNK_BLOCKS]
        seen = [max(0.0, max(b[f] for b in chunk) + float(w["bias"][f])) for f in range(quality.FILTERS)]
        hidden.append([math.tanh(sum(s * float(w["in"][f, h]) for f, s in enumerate(seen)) + float(w["in0"][h])) for h in range(quality.HIDDEN)])
    pooled = [sum(x[h] for x in hidden) / len(hidden) for h in range(quality.HIDDEN)] + [max(x[h] for x in hidden) for h in range(quality.HIDDEN)]
    return 1 / (1 + math.exp(-sum(p * float(o) for p, o in zip(pooled, w["out"], strict=True)) - float(w["out0"][0])))


def test_network_by_plain_python():
    w = quality.start(4)
    w["bias"] += 0.1
    w["in0"] += 0.05
    for n in (0, 1, 63, 64, 65, 448, 449, 512, 513, 1500):
        data = (text(300, n).encode() * 2)[:n]
        # Bytes that follow the text in a batch are read by no other text's filters but zeros.
        got = quality.probabilities(np.frombuffer(data, np.uint8), np.array([0, n]), w)[0]
        assert abs(got - plain_quality(data, w)) < 1e-4, n


def test_samples_are_bounded(spark, monkeypatch):
    """Rows come up to the bound, in the order of their hashes; nulls, repeated ids and two labels have a defined result."""
    docs = spark.createDataFrame([(i, "word " * 20 + str(i)) for i in range(50)] + [(3, "another"), (None, "x"), (4, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(50)] + [(3, 0, 0), (None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    rows = toxicity.training_rows(docs, labels, "toxic", 10_000)
    assert rows.count() == 52 and {r.label for r in rows.filter("doc_id = 3").collect()} == {1}
    few = toxicity.within(rows, F.octet_length(F.coalesce("text", F.lit(""))), 1000)
    assert 5 < few.count() < 12
    monkeypatch.setattr(quality, "TRAIN_BYTES", 1000)
    monkeypatch.setattr(toxicity, "TRAIN_TERMS", 100)
    for module in (quality, toxicity):
        found = module.score(docs, module.fit(docs, labels)).collect()
        assert len(found) == 53 and all(0 <= r.score <= 1 for r in found)
    again = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert sorted((str(r.doc_id), r.text or "", r.score) for r in again) == sorted((str(r.doc_id), r.text or "", r.score) for r in found)

"""Both classifiers against plain versions: dictionaries and loops, one n-gram, document and dimension at a time."""

import io
import math

import numpy as np
from conftest import SMALL

from tidewater.llm import quality, toxicity

M = 0xFFFFFFFF


def padded(text):
    words = (text or "").lower().encode().split()
    return b" " + b" ".join(words) + b" " if words else b" "


def gram(data, bits):
    h = 0x811C9DC5
    for b in data:
        h = (h ^ (b + 1)) * 0x01000193 & M
    return (h * 0x9E3779B1 & M) >> (32 - bits)


def grams(text, orders, bits):
    data = padded(text)
    return [gram(data[i : i + n], bits) for n in orders for i in range(len(data) - n + 1)]


def word(data, bits):
    h = sum((b + 7) * pow(0x01000193, k + 1, 1 << 32) for k, b in enumerate(data, 1)) & M
    return (h * 0x9E3779B1 & M) >> (32 - bits)


def sigmoid(x):
    return 1 / (1 + math.exp(-min(35, max(-35, x))))


def sample(spark, label, n):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id").orderBy("doc_id").collect()
    one = [r for r in docs if r[label] == 1][: n // 2]
    other = [r for r in docs if r[label] == 0][: n - len(one)]
    return [(r.text[:600], r[label]) for r in one + other]


def test_toxicity_by_the_definition(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "ROUNDS", 6)
    monkeypatch.setattr(toxicity, "LEAST_DOCUMENTS", 2)
    rows = sample(spark, "toxic", 24)
    texts, labels = [t for t, _ in rows], [y for _, y in rows]
    assert 0 < sum(labels) < len(labels)
    sets = [set(grams(t, toxicity.ORDERS, toxicity.BITS)) for t in texts]
    counts = {}
    for s, y in zip(sets, labels):
        for g in s:
            counts.setdefault(g, [0, 0])[y] += 1
    n = [labels.count(0), labels.count(1)]
    ratio = {g: math.log((c[1] + 1) / (n[1] + 2)) - math.log((c[0] + 1) / (n[0] + 2)) for g, c in counts.items()}
    ratio = {g: r for g, r in ratio.items() if abs(r) >= toxicity.LEAST_RATIO and sum(counts[g]) >= 2}
    w, m, v = dict.fromkeys(ratio, 0.0), dict.fromkeys([*ratio, "bias"], 0.0), dict.fromkeys([*ratio, "bias"], 0.0)
    bias = math.log((n[1] + 0.5) / (n[0] + 0.5))
    for k in range(1, 7):
        errors = [(sigmoid(sum(w[g] * ratio[g] for g in s if g in ratio) + bias) - y) / len(rows) for s, y in zip(sets, labels)]
        grad = {g: toxicity.L2 * w[g] for g in ratio} | {"bias": sum(errors)}
        for s, e in zip(sets, errors):
            for g in s:
                if g in ratio:
                    grad[g] += e * ratio[g]
        for g, x in grad.items():
            m[g], v[g] = 0.9 * m[g] + 0.1 * x, 0.99 * v[g] + 0.01 * x * x
            step = 0.03 * (m[g] / (1 - 0.9**k)) / (math.sqrt(v[g] / (1 - 0.99**k)) + 1e-9)
            if g == "bias":
                bias -= step
            else:
                w[g] -= step
    score = toxicity.scorer(toxicity.train(texts, labels))
    other = ["", None, "abc", "a new text " * 5, *texts[:4], "Ünïcode 漢字 x"]
    for t in other:
        want = sigmoid(sum(w[g] * ratio[g] for g in set(grams(t, toxicity.ORDERS, toxicity.BITS)) if g in ratio) + bias)
        assert abs(score(t) - want) < 1e-5, t


def bag(text):
    words = [word(x, quality.BITS) ^ 0x5A5A for x in padded(text).split()]
    again = [k for k in (1, 2) for i in range(k, len(words)) if words[i] == words[i - k]]
    return [*grams(text, quality.ORDERS, quality.BITS), *words, *again]


def test_quality_by_the_definition(spark, monkeypatch):
    monkeypatch.setattr(quality, "EPOCHS", 2)
    monkeypatch.setattr(quality, "BATCH", 5)
    rows = sample(spark, "quality", 14)
    texts, labels = [t for t, _ in rows], [y for _, y in rows]
    rng = np.random.default_rng(11)
    vectors = rng.uniform(-1 / quality.DIM, 1 / quality.DIM, (1 << quality.BITS, quality.DIM)).tolist()
    share = [labels.count(0) + 0.5, labels.count(1) + 0.5]
    out, bias = [[0.0, 0.0] for _ in range(quality.DIM)], [math.log(s / sum(share)) for s in share]
    squares, out_squares = {}, 1e-6
    bags = [bag(t) for t in texts]
    for _ in range(2):
        order = rng.permutation(len(bags)).tolist()
        for k in range(0, len(order), 5):
            grad, d_out, d_bias, total, batch = {}, [[0.0, 0.0] for _ in range(quality.DIM)], [0.0, 0.0], 0.0, order[k : k + 5]
            for i in batch:
                hidden = [sum(vectors[b][d] for b in bags[i]) / len(bags[i]) for d in range(quality.DIM)]
                z = [sum(hidden[d] * out[d][c] for d in range(quality.DIM)) + bias[c] for c in (0, 1)]
                e = [math.exp(x - max(z)) for x in z]
                p = [x / sum(e) - (c == labels[i]) for c, x in enumerate(e)]
                total += sum(x * x for x in p) / (2 * len(batch))
                back = [sum(p[c] * out[d][c] for c in (0, 1)) for d in range(quality.DIM)]
                for d in range(quality.DIM):
                    for c in (0, 1):
                        d_out[d][c] += hidden[d] * p[c]
                for c in (0, 1):
                    d_bias[c] += p[c] / len(batch)
                for b in bags[i]:
                    own = grad.setdefault(b, [0.0] * quality.DIM)
                    for d in range(quality.DIM):
                        own[d] += back[d] / len(bags[i])
            out_squares += total
            step = quality.RATE / math.sqrt(out_squares)
            for c in (0, 1):
                bias[c] -= step * d_bias[c]
                for d in range(quality.DIM):
                    out[d][c] -= step * d_out[d][c]
            for b, g in grad.items():
                squares[b] = squares.get(b, 1e-6) + sum(x * x for x in g) / quality.DIM
                for d in range(quality.DIM):
                    vectors[b][d] -= quality.RATE * g[d] / math.sqrt(squares[b])
    score = quality.scorer(quality.train(texts, labels))
    for t in ["", None, "word word word", "a b a b", *texts[:4], "Ünïcode 漢字 x"]:
        own = bag(t)
        hidden = [sum(vectors[b][d] for b in own) / max(1, len(own)) for d in range(quality.DIM)]
        want = sigmoid(sum(hidden[d] * (out[d][1] - out[d][0]) for d in range(quality.DIM)) + bias[1] - bias[0])
        assert abs(score(t) - want) < 1e-4, t
    with np.load(io.BytesIO(quality.train(texts, labels))) as f:
        assert len(f["projection"]) == 1 << quality.BITS

"""Toxicity: a linear classifier over distinct character n-grams scaled by naive Bayes log-count ratios.

Ratios and weights are learnt from a bounded sample of labelled rows; every whole text is scored where it lies.
"""

from __future__ import annotations

import io

import numpy as np
from pyspark.sql import DataFrame

from .features import Distinct, char_grams, sigmoid, text_bytes
from .labelled import fit, score, training_sample

ORDERS = (4, 5, 6)
BITS = 20
MAX_TRAIN_ROWS = 6000
SMOOTHING = 1.0
LEAST_RATIO = 1.8
LEAST_DOCUMENTS = 8
L2 = 2e-3
ROUNDS = 80


def train(texts: list[str], labels: list[int]) -> bytes:
    """Weights by bucket (log-count ratio times linear weight) and the bias, as an npz file. One class only: its smoothed share."""
    size, distinct = 1 << BITS, Distinct(BITS)
    y = np.asarray(labels, dtype=np.float64)
    weights, bias = np.zeros(size, np.float32), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))) if len(y) else 0.0
    if 0 < y.sum() < len(y):
        counts = np.zeros((2, size))
        for text, label in zip(texts, labels):
            counts[label][distinct(char_grams(text_bytes(text), ORDERS, BITS))] += 1
        rate = (counts + SMOOTHING) / (np.array([[len(y) - y.sum()], [y.sum()]]) + 2 * SMOOTHING)
        ratio = np.log(rate[1] / rate[0])
        ratio[(np.abs(ratio) < LEAST_RATIO) | (counts.sum(0) < LEAST_DOCUMENTS)] = 0.0
        # hashed again, since only the few n-grams that tell the classes apart are worth holding
        rows = [r[ratio[r] != 0].astype(np.int32) for r in (distinct(char_grams(text_bytes(t), ORDERS, BITS)) for t in texts)]
        idx, of = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        x = ratio[idx]
        w, m, v = np.zeros(size), np.zeros(size + 1), np.zeros(size + 1)
        for k in range(1, ROUNDS + 1):
            margin = np.bincount(of, w[idx] * x, minlength=len(y)) + bias
            err = (sigmoid(margin) - y) / len(y)
            g = np.append(np.bincount(idx, err[of] * x, minlength=size) + L2 * w, err.sum())
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            step = 0.03 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
            w -= step[:-1]
            bias -= step[-1]
        weights = (w * ratio).astype(np.float32)
    out = io.BytesIO()
    np.savez(out, weights=weights, bias=np.float64(bias))
    return out.getvalue()


def scorer(model: bytes):
    """A function from a text to its score."""
    with np.load(io.BytesIO(model)) as f:
        weights, bias = f["weights"], float(f["bias"])
    distinct = Distinct(BITS)

    def one(text: str | None) -> float:
        return float(sigmoid(weights[distinct(char_grams(text_bytes(text), ORDERS, BITS))].sum(dtype=np.float64) + bias))

    return one


def train_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_train_rows: int = MAX_TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """Fit on at most max_train_rows labelled documents."""
    return fit(training_sample(docs, labels, label_col, max_train_rows, id_col, text_col), train)


def score_toxicity(df: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """df with a column score (0 to 1, higher: more likely toxic).

    Defined cases: null and empty texts and texts shorter than an n-gram score the model's bias; without labelled rows of
    both classes every score is the smoothed share of label 1 (0.5 without labels); an empty table stays empty; a column of
    df named score is replaced; other columns stay.
    """
    held = df.sparkSession.sparkContext.broadcast(model)  # 4 MB whatever the corpus
    return score(df, lambda: scorer(held.value), text_col)

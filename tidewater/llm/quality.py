"""Quality: supervised subword embeddings. Hashed word and character n-gram vectors are averaged per document and a
softmax over the average gives the class; vectors and softmax are learnt together by stochastic gradient descent in numpy.

Scoring needs only each bucket's projection on the difference of the two class vectors, because the average is linear.
"""

from __future__ import annotations

import io

import numpy as np
from pyspark.sql import DataFrame

from .features import char_grams, sigmoid, text_bytes, word_buckets
from .labelled import fit, score, training_sample

ORDERS = (3, 4)
BITS = 16
DIM = 8
MAX_TRAIN_ROWS = 5000
EPOCHS = 6
BATCH = 25
RATE = 0.5


def buckets(text: str | None) -> np.ndarray:
    """Character n-grams, words, and one token for every word that equals the word one or two places before it."""
    data = text_bytes(text)
    words = word_buckets(data, BITS) ^ np.uint32(0x5A5A)
    again = [np.full(int((words[k:] == words[:-k]).sum()), k, np.uint32) for k in (1, 2)]
    return np.concatenate([char_grams(data, ORDERS, BITS), words, *again])


def train(texts: list[str], labels: list[int]) -> bytes:
    """Projection by bucket and the bias, as an npz file. One class only: its smoothed share."""
    y = np.asarray(labels, dtype=np.int64)
    size = 1 << BITS
    share = np.array([(y == 0).sum() + 0.5, (y == 1).sum() + 0.5])
    rng = np.random.default_rng(11)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (size, DIM))
    out_vectors, out_bias = np.zeros((DIM, 2)), np.log(share / share.sum())
    if len(set(labels)) == 2:
        bags = [(idx.astype(np.uint16), n.astype(np.int32)) for idx, n in (np.unique(buckets(t), return_counts=True) for t in texts)]  # BITS is 16
        squares, out_squares = np.full(size, 1e-6), 1e-6  # adaptive steps by bucket
        for epoch in range(EPOCHS):
            order = rng.permutation(len(bags))
            for k in range(0, len(order), BATCH):
                rows = [i for i in order[k : k + BATCH] if len(bags[i][0])]
                if not rows:
                    continue
                idx = np.concatenate([bags[i][0] for i in rows]).astype(np.int64)
                of = np.repeat(np.arange(len(rows)), [len(bags[i][0]) for i in rows])
                part = np.concatenate([bags[i][1] / bags[i][1].sum() for i in rows])
                starts = np.concatenate([[0], np.cumsum([len(bags[i][0]) for i in rows])[:-1]])
                hidden = np.add.reduceat(vectors[idx] * part[:, None], starts, axis=0)
                logits = hidden @ out_vectors + out_bias
                p = np.exp(logits - logits.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(rows)), y[rows]] -= 1
                back = p @ out_vectors.T
                out_squares += float((p**2).mean())
                out_vectors -= RATE / np.sqrt(out_squares) * hidden.T @ p
                out_bias -= RATE / np.sqrt(out_squares) * p.mean(0)
                used, inverse = np.unique(idx, return_inverse=True)
                grad = np.stack([np.bincount(inverse, part * back[of, d], minlength=len(used)) for d in range(DIM)], axis=1)
                squares[used] += (grad**2).mean(1)
                vectors[used] -= RATE * grad / np.sqrt(squares[used])[:, None]
    out = io.BytesIO()
    np.savez(out, projection=(vectors @ (out_vectors[:, 1] - out_vectors[:, 0])).astype(np.float32), bias=np.float64(out_bias[1] - out_bias[0]))
    return out.getvalue()


def scorer(model: bytes):
    """A function from a text to the softmax output of class 1."""
    with np.load(io.BytesIO(model)) as f:
        projection, bias = f["projection"], float(f["bias"])

    def one(text: str | None) -> float:
        idx = buckets(text)
        return float(sigmoid((projection[idx].mean(dtype=np.float64) if len(idx) else 0.0) + bias))

    return one


def train_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_train_rows: int = MAX_TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """Fit on at most max_train_rows labelled documents."""
    return fit(training_sample(docs, labels, label_col, max_train_rows, id_col, text_col), train)


def score_quality(df: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """df with a column score (0 to 1, higher: more likely of good quality).

    Defined cases: null and empty texts score the model's bias; without labelled rows of both classes every score is the
    smoothed share of label 1 (0.5 without labels); an empty table stays empty; a column of df named score is replaced.
    """
    held = df.sparkSession.sparkContext.broadcast(model)  # 0.3 MB whatever the corpus
    return score(df, lambda: scorer(held.value), text_col)

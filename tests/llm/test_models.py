"""Classifiers and language model: held-out accuracy, brute force, edge cases."""

import math
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tidewater.llm import lm, quality, queries, toxicity
from tidewater.llm.shingles import mix_int

LABELLED = "/root/testdata/sf0.1"


@pytest.mark.parametrize("op, modulus, held, label, least", [("op1_toxicity", 5, 0, "toxic", 0.96), ("op6_quality", 3, 1, "quality", 0.97)])
def test_held_out_accuracy(spark, op, modulus, held, label, least):
    got = queries.QUERIES[op](spark, LABELLED)
    docs = spark.read.parquet(f"{LABELLED}/documents.parquet")
    assert got.count() == docs.count() and got.filter("score is null or score < 0 or score > 1 or (score >= 0.5) <> (predicted = 1)").count() == 0
    rows = got.join(spark.read.parquet(f"{LABELLED}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % modulus == held for r in rows)
    assert sum(r.predicted == r[label] for r in rows) / len(rows) >= least


@pytest.mark.parametrize("mod, fit, score, label", [(toxicity, toxicity.train_toxicity, toxicity.score_toxicity, "toxic"), (quality, quality.train_quality, quality.score_quality, "quality")])
def test_edge_cases(spark, mod, fit, score, label):
    docs = spark.createDataFrame([(1, "good words here", 0.0), (2, None, 1.0), (3, "", 2.0), (None, "x", 3.0), (4, "a " * 60000, None), (4, "a " * 60000, None)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    odd = spark.createDataFrame([(1, 1), (1, 1), (None, 0), (2, None), (99, 0)], f"doc_id long, {label} int")
    for labels in (none, odd):
        out = score(docs, fit(docs, labels))
        assert out.columns == docs.columns and out.count() == 6 and out.filter("score is null or score < 0 or score > 1").count() == 0
    assert {r.score for r in score(docs, fit(docs, none)).collect()} == {0.5}
    assert score(docs.limit(0), fit(docs, odd)).count() == 0 and score(docs, fit(docs.limit(0), odd)).count() == 6


def brute(docs):
    count = Counter(t for train, text in docs if train for t in lm.tokens(text))
    n, v = sum(count.values()), len(count)
    return [(len(ts), sum(t in count for t in ts), n, sum(math.log10((count[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)) for ts in (lm.tokens(text) for _, text in docs)]


def test_lm_against_brute_force(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op9_lm"](spark, SMALL).collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = brute([(zlib.crc32(str(i).encode()) % 10 != 0, t) for i, t in docs])
    better = 0
    for (i, _), (n, known, total, base) in zip(docs, want):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and abs(r.base_score - base) < 1e-6 * abs(base)
        better += r.score > r.base_score
    assert better > 0.9 * len(docs)


def test_lm_edge_cases(spark):
    rows = [(1, "The the THE a", 1), (2, None, 1), (3, "", 0), (None, "unseen é words\tand\x0bmore", 0), (5, "a " * 30000, 1), (5, "a " * 30000, 1), (6, "x" * 100000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = lm.score_texts(df, F.col("n_tokens") == 1).collect()
    want = brute([(r[2] == 1, r[1]) for r in rows])
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted((n, k, t, round(b, 6)) for n, k, t, b in want)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert lm.score_texts(df.limit(0), F.lit(True)).count() == 0
    assert all(math.isfinite(r.score) for r in lm.score_texts(df, F.lit(False)).collect())


M64 = 2**64 - 1


def word_hash(word):
    n = len(word)
    head, tail = int.from_bytes(word[:8], "little"), int.from_bytes(word[-8:], "little") if n > 8 else 0
    return mix_int(mix_int(head + n * int(lm._Q) & M64) ^ (tail * int(lm._P) & M64)) if word else 0


def member_of(word, singles):
    if word == lm.END:
        return 0
    return singles.index(word) + 1 if word in singles else 1 + lm.SINGLES + zlib.crc32(word[-2:]) % lm.ENDINGS


def chances(w, history, singles):
    """Probability of every member after the three words of history (the last word first), by the definition, feature by feature."""
    m, h = [member_of(x, singles) for x in history], [word_hash(x) & 0xFFFFFFFF for x in history]
    raw = [h[0] * 4 + 1, h[1] * 4 + 2, (m[0] * lm.MEMBERS + m[1]) * 4 + 3, (m[0] * lm.MEMBERS + m[2]) * 4]
    raw = [r * int(lm._P) & M64 for r in raw]
    row = lambda x: 1 + lm.CLASSES + ((x >> 32) * (lm.ROWS - 1 - lm.CLASSES) >> 32)

    def softmax(rows):
        z = w[rows].astype(np.float64).sum(0)
        return np.exp(z - z.max()) / np.exp(z - z.max()).sum()

    first = softmax([0, *map(row, raw)])
    inside = [softmax([1 + c, *(row(mix_int(r ^ ((c + 1) * int(lm._Q) & M64))) for r in raw)]) for c in range(lm.CLASSES)]
    return np.concatenate([first[c] * inside[c] for c in range(lm.CLASSES)])


def test_lm_score_against_brute_force(spark, monkeypatch):
    seen = {}
    fit = lm._fit

    def spy(blocks, singles, start):
        seen.update(singles=singles, w=fit(blocks, singles, start))
        return seen["w"]

    monkeypatch.setattr(lm, "_fit", spy)
    docs = [(r.doc_id, r.text[:700]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(60).collect()] + [(900, None), (901, "a-word-of-more-than-sixteen-bytes é x")]
    train = {i: i % 3 != 0 for i, _ in docs}
    got = {r.doc_id: r.score for r in lm.score_texts(spark.createDataFrame(docs, "doc_id long, text string"), F.col("doc_id") % 3 != 0).collect()}
    w, singles = seen["w"], seen["singles"]
    assert np.abs(w).sum() > 0 and len(singles) == lm.SINGLES
    count = Counter(t for i, text in docs if train[i] for t in lm.tokens(text))
    size, kinds = Counter(), Counter()
    for word, n in count.items():
        size[member_of(word, singles)] += n
        kinds[member_of(word, singles)] += 1
    for i, text in docs[::6] + docs[-2:]:
        words, total = [lm.END] * 3 + lm.tokens(text), 0.0
        for k in range(3, len(words)):
            p = chances(w, words[k - 3 : k][::-1], singles)
            assert abs(p.sum() - 1) < 1e-6
            m = member_of(words[k], singles)
            total += math.log10(p[m]) + math.log10((count[words[k]] + 0.1) / (size[m] + 0.1 * (kinds[m] + 1)))
        assert abs(got[i] - total) < 1e-3 * max(1, abs(total)), i


_HELD = """
import random, re
from pathlib import Path
import pandas, pyarrow.compute
from tidewater.llm import labelled, quality, toxicity

def held():
    return int(re.search(r"RssAnon:\\s+(\\d+)", Path("/proc/self/status").read_text())[1]) // 1024

rng = random.Random(5)
words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(200_000)]
rows = [(k, " ".join(rng.choices(words, k=700)), k % 2) for k in range(1500)]
for m in (toxicity, quality):
    labelled.fitted(rows[:20], m.train)
    before = held()
    labelled.fitted(rows[:], m.train)
    print(held() - before)
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_training_gives_its_memory_back():
    """MB that a worker process holds after training, beyond those before it."""
    out = subprocess.run([sys.executable, "-c", _HELD], capture_output=True, text=True, timeout=300, check=True).stdout
    assert all(int(left) < 25 for left in out.split()) and len(out.split()) == 2

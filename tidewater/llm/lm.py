"""Language-model scoring: a hashed maximum-entropy model with class-factored softmax, beside a smoothed unigram base.

log P(token | history) = log P(class | history) + log P(member | class, history) + log P(token | member). The end of a text
and the most frequent tokens are members alone; every other token belongs to the member of its hashed word ending. GROUP
members form a class. Both choices are softmaxes over hashed n-gram and skip features of the three tokens before, the second
with weights of its own for each class. P(token | member) comes from the counts, one unseen token per member included, so
the probabilities of all outcomes sum to 1.

Jobs: texts are put into blocks of bounded size; each block asks for the counts of its distinct words, so a frequent word
has one row per block however often it occurs; counts are summed over the corpus and sent back to the blocks, which score
their documents in numpy batches. Weights are fitted by gradient steps inside every input partition over all training
texts and averaged row by row in a tree, so neither vocabulary nor gradients pass through the driver or one task.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_characters, materialize
from .shingles import mix

#: Members of a class, classes, members that are one frequent token each, members that are a hashed ending each.
GROUP, CLASSES, SINGLES, ENDINGS = 16, 16, 127, 128
MEMBERS = 1 + SINGLES + ENDINGS  # member 0 is the end of a text
ROW_BITS = 15
ROWS = 1 << ROW_BITS  # of weights, GROUP numbers each
CHUNK = 1024
STEP = 16384
RATE = 0.1
BLOCK_CHARS = 12_000_000
SMOOTHING = 0.1
FAN = 32
END = b""


def tokens(text: str | None) -> list[bytes]:
    """A-Z lower-cased words, runs of bytes other than blank and 0x09 to 0x0D, then the end token."""
    return [*(text or "").encode("utf-8", "replace").lower().split(), END]


#: crc32 of every two bytes, and of every single byte, modulo ENDINGS.
_TWO = np.array([zlib.crc32(bytes((a, b))) % ENDINGS for a in range(256) for b in range(256)], np.int64)
_ONE = np.array([zlib.crc32(bytes((a,))) % ENDINGS for a in range(256)], np.int64)
_P, _Q, _MASK = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFFFFFFFF)


class Codes:
    """member << 32 | hash of every token of a text, without a look-up per word."""

    def __init__(self, singles: list[bytes]):
        own = sorted(zip(_hashes(*_joined(singles)).tolist(), range(1, len(singles) + 1))) if singles else []
        self.own = np.array([h for h, _ in own], np.uint64)
        self.members = np.array([k for _, k in own], np.int64)

    def of(self, words: list[bytes]) -> np.ndarray:
        """words: as tokens() gives them, the end token last."""
        codes = np.zeros(len(words), np.int64)
        body = words[:-1]
        if body:
            data, lengths = _joined(body)
            h, last = _hashes(data, lengths), np.cumsum(lengths) - 1
            tail = data[last].astype(np.int64)
            kind = 1 + SINGLES + np.where(lengths > 1, _TWO[data[np.maximum(last - 1, 0)].astype(np.int64) * 256 + tail], _ONE[tail])
            if len(self.own):
                at = np.minimum(np.searchsorted(self.own, h), len(self.own) - 1)
                kind = np.where(self.own[at] == h, self.members[at], kind)
            codes[:-1] = kind << 32 | (h & _MASK).astype(np.int64)
        return codes


def _joined(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all words and 8 zeros, lengths)."""
    return np.frombuffer(b"".join([*words, b"\0" * 8]), np.uint8), np.fromiter(map(len, words), np.int64, len(words))


def _hashes(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of words that are not empty, from the first and last eight bytes and the length: words of up to 16
    bytes differ whenever these do, and longer ones need no more to be features."""
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    end = np.cumsum(lengths)
    start = end - lengths
    cut = np.uint64(8) * (np.uint64(8) - np.minimum(lengths, 8).astype(np.uint64))
    head = (eight[start] << cut) >> cut
    return mix(mix(head + lengths.astype(np.uint64) * _Q) ^ eight[np.maximum(start, end - 8)] * _P * (lengths > 8))


def features(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(members to predict, 64-bit hashes of their features (4, n)) of texts in a row; before a text stand end tokens."""
    pad = np.zeros(3, np.int64)
    flat = np.concatenate([x for c in codes for x in (pad, c)])
    sizes = np.array([len(c) for c in codes])
    at = np.arange(int(sizes.sum())) + np.repeat(3 * np.arange(1, len(codes) + 1), sizes)
    k, h = (flat >> 32).astype(np.uint64), (flat & 0xFFFFFFFF).astype(np.uint64)
    one, two, three = at - 1, at - 2, at - 3
    raw = np.stack([
        h[one] * np.uint64(4) + np.uint64(1),  # the word before
        h[two] * np.uint64(4) + np.uint64(2),  # skip: the word before that
        (k[one] * np.uint64(MEMBERS) + k[two]) * np.uint64(4) + np.uint64(3),  # two members
        (k[one] * np.uint64(MEMBERS) + k[three]) * np.uint64(4),  # skip: two members with a gap
    ])
    return k[at].astype(np.int64), raw * _P


def choices(members: np.ndarray, raw: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The two choices that make each token, class and member of the class, each as (outcomes (n), weight rows).

    The first row of a choice is its bias: 0 for classes, 1 + class for members.
    """
    kind, inside = np.divmod(members, GROUP)
    low, span = 1 + CLASSES, np.uint64(ROWS - 1 - CLASSES)
    own = mix(raw ^ ((kind + 1).astype(np.uint64) * _Q))
    return [
        (y, np.concatenate([bias[None], low + (((hashed >> np.uint64(32)) * span) >> np.uint64(32)).astype(np.int64)]))
        for y, bias, hashed in ((kind, np.zeros_like(kind), raw), (inside, 1 + kind, own))
    ]


def _shifted(w: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores of all outcomes of choices under weights w, outcomes first; the best of each choice is 0."""
    z = np.take(w, rows[0], axis=0, mode="clip")
    for k in range(1, len(rows)):
        z += np.take(w, rows[k], axis=0, mode="clip")
    z = np.ascontiguousarray(z.T)  # maxima and sums run over whole rows
    z -= z.max(0)
    return z


def log_probs(w: np.ndarray, y: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """log P(outcome y) of choices under weights w."""
    z = _shifted(w, rows)
    own = z[y, np.arange(len(y))]
    return own - np.log(np.exp(z, out=z).sum(0))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of runs of rows that begin at first; short runs, which are the most, are added without a loop over runs."""
    size = np.diff(np.append(first, len(values)))
    out = values[first]
    for k in range(1, 4):
        more = np.flatnonzero((size > k) & (size <= 4))
        out[more] += values[first[more] + k]
    if len(long := np.flatnonzero(size > 4)):
        ends = np.cumsum(size[long])
        at = np.arange(int(ends[-1])) + np.repeat(first[long] - (ends - size[long]), size[long])
        out[long] = np.add.reduceat(values[at], ends - size[long], axis=0)
    return out


def biases(counts: np.ndarray) -> np.ndarray:
    """Bias rows that give every member its share of the counts."""
    inside = np.log(counts.reshape(CLASSES, GROUP) + 1)
    per_class = np.log((counts.reshape(CLASSES, GROUP) + 1).sum(1))
    return np.concatenate([per_class[None], inside - per_class[:, None]])


class Fit:
    """Gradient steps of one partition, with a step size of its own for every weight row."""

    def __init__(self, start: np.ndarray):
        self.w, self.squares, self.seen = start.copy(), np.full(len(start), 1.0, np.float32), np.zeros(len(start))

    def step(self, members: np.ndarray, raw: np.ndarray) -> None:
        for y, rows in choices(members, raw):
            z = _shifted(self.w, rows)
            np.exp(z, out=z)
            z /= z.sum(0)
            z[y, np.arange(len(y))] -= 1
            g = np.ascontiguousarray(z.T)
            own = rows[0] if rows[0].any() else rows[0, :1]
            used = np.unique(own)
            bias = z.sum(1)[None] if len(own) == 1 else (used[:, None] == own).astype(np.float32) @ g
            self._add(used, bias, np.bincount(rows[0])[used])
            flat = rows[1:].ravel()
            order = np.argsort(flat.astype(np.uint16), kind="stable")  # ROWS fits 16 bits, which sort in linear time
            flat = flat[order]
            first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
            self._add(flat[first], sums(np.take(g, order % len(y), axis=0), first), np.diff(np.append(first, len(flat))))

    def _add(self, used: np.ndarray, grad: np.ndarray, times: np.ndarray) -> None:
        squares = self.squares[used] + np.einsum("ij,ij->i", grad, grad) / GROUP
        self.squares[used] = squares
        self.w[used] -= grad * (RATE / np.sqrt(squares))[:, None]
        self.seen[used] += times


def _blocks(df: DataFrame, id_col: str, text_col: str, train) -> DataFrame:
    """(_x_id, _x_text, _x_train, block): blocks of at most BLOCK_CHARS characters, or one text."""
    slim = df.select(F.col(id_col).alias("_x_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_x_text"), train.alias("_x_train"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 24, 0
        for batch in batches:
            out = []
            for n in pa.compute.utf8_length(batch.column(1)).to_pylist():
                if held and held + n > BLOCK_CHARS:
                    block, held = block + 1, 0
                held += n
                out.append(block)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*batch.schema.names, "block"])

    kind = slim.schema["_x_id"].dataType.simpleString()
    return materialize(slim.mapInArrow(run, f"_x_id {kind}, _x_text string, _x_train boolean, block bigint"), "lm-blocks")


def _requests(blocks: DataFrame) -> DataFrame:
    """(block, word, c): the distinct words of each block with their count in its training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[Counter, set]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for block, (counts, others) in held.items():
                words = [*counts, *(w for w in others if w not in counts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(words), block)), pa.array(words, pa.binary()), pa.array(np.fromiter((counts[w] for w in words), np.int64, len(words)))],
                    names=["block", "word", "c"],
                )
            held.clear()

        for batch in by_characters(batches, 1, BLOCK_CHARS):
            for text, train, block in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                if block not in held:
                    yield from flush()
                    held[block] = Counter(), set()
                held[block][0 if train else 1].update(tokens(text))
        yield from flush()

    return materialize(blocks.mapInArrow(run, "block bigint, word binary, c bigint"), "lm-requests")


def _fit(blocks: DataFrame, singles: list[bytes], start: np.ndarray) -> np.ndarray:
    """Weights after one pass over all training texts, averaged over partitions by how often each row was used."""
    held = blocks.sparkSession.sparkContext.broadcast((singles, start))  # 2 MB whatever the corpus, ROWS x GROUP numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        own, begin = held.value
        codes, fit, waiting, size = Codes(own), Fit(begin), [], 0

        def steps():
            y, f = features(waiting)
            for k in range(0, len(y), STEP):
                fit.step(y[k : k + STEP], f[:, k : k + STEP])

        for batch in by_characters(batches, 0, 16 * STEP * 8):
            for text in batch.column(0).to_pylist():
                waiting.append(codes.of(tokens(text)))
                size += len(waiting[-1])
                if size >= 16 * STEP:
                    steps()
                    waiting, size = [], 0
        if waiting:
            steps()
        if fit.seen.any():
            part = TaskContext.get().partitionId()
            n = ROWS // CHUNK
            total = fit.w * fit.seen[:, None]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part, np.int64)), pa.array(np.arange(n, dtype=np.int64)),
                    pa.array([total[k * CHUNK : (k + 1) * CHUNK].astype(np.float64).tobytes() for k in range(n)], pa.binary()),
                    pa.array([fit.seen[k * CHUNK : (k + 1) * CHUNK].tobytes() for k in range(n)], pa.binary()),
                ],
                names=["part", "chunk", "total", "seen"],
            )

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x) for x in rows["total"])
        seen = sum(np.frombuffer(x) for x in rows["seen"])
        return pd.DataFrame({"part": [key[0]], "chunk": [key[1]], "total": [total.tobytes()], "seen": [seen.tobytes()]})

    schema = "part bigint, chunk bigint, total binary, seen binary"
    texts = blocks.filter("_x_train").select("_x_text")
    sums, parts = texts.mapInArrow(run, schema), texts.rdd.getNumPartitions()  # the number is read from the plan; no job runs
    while True:  # a tree: no task adds up more than FAN partitions' rows
        sums = sums.groupBy(F.expr(f"part div {FAN}").alias("part"), "chunk").applyInPandas(add, schema)
        parts = -(-parts // FAN)
        if parts <= 1:
            break
    w = start.copy()
    for row in sums.collect():  # ROWS rows of GROUP numbers, whatever the corpus
        seen, total = np.frombuffer(row["seen"]), np.frombuffer(row["total"]).reshape(CHUNK, GROUP)
        used = seen > 0
        w[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK][used] = (total[used] / seen[used, None]).astype(np.float32)
    return w


def score_texts(df: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", passes: int = 1) -> DataFrame:
    """One row per input row: id, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities of the text).

    train says, as a Column over df, which rows to learn from. Defined cases: null and empty texts are one end token; null
    in train counts as false; weights are averaged over the input's partitions, so scores depend a little on how it is split; without training rows every token has the same probability; rows that repeat an id are scored each; an empty table
    gives an empty result; other columns of df are ignored, whatever their names.
    """
    blocks = _blocks(df, id_col, text_col, F.coalesce(train, F.lit(False)))
    asked = _requests(blocks)
    vocab = materialize(asked.groupBy("word").agg(F.sum("c").alias("n")).filter("n > 0"), "lm-vocabulary")
    short = F.octet_length("word").between(1, 16)  # such words are known by their hash alone
    singles = [bytes(r[0]) for r in vocab.filter(short).orderBy(F.desc("n"), "word").limit(SINGLES).collect()]
    listed = F.array(*[F.lit(w) for w in singles]).cast("array<binary>")
    kind = F.when(F.octet_length("word") == 0, 0).otherwise(
        F.when(F.array_position(listed, F.col("word")) > 0, F.array_position(listed, F.col("word")))
        .otherwise(F.crc32(F.substring("word", -2, 2)) % ENDINGS + 1 + SINGLES)
    )
    stats = np.zeros((MEMBERS, 2))
    for r in vocab.groupBy(kind.cast("int").alias("k")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        stats[r["k"]] = r["n"], r["v"]
    w = np.zeros((ROWS, GROUP), np.float32)
    w[: 1 + CLASSES] = biases(stats[:, 0])
    for _ in range(passes):
        w = _fit(blocks, singles, w)
    held = df.sparkSession.sparkContext.broadcast((singles, stats, w))  # bounded like the weights
    # a frequent word has a row per block; the exchange is the join's own, so Spark can split such a word's partition
    answers = asked.select("block", "word").join(vocab, "word").select("block", "word", "n")
    n_all, v_all = int(stats[:, 0].sum()), int(stats[:, 1].sum())

    def run(texts: pa.Table, counts: pa.Table) -> pa.Table:
        own, stat, weights = held.value
        codes = Codes(own)
        count = dict(zip(counts.column("word").to_pylist(), counts.column("n").to_pylist())).get
        per_member = np.log(stat[:, 0] + SMOOTHING * (stat[:, 1] + 1))
        n_known, n_tokens, base, score = [], [], [], []
        source, waiting = texts.column("_x_text").to_pylist(), []
        for i, text in enumerate(source):
            waiting.append(tokens(text))
            if i + 1 < len(source) and sum(map(len, waiting)) < 16 * STEP:
                continue
            sizes = np.array([len(t) for t in waiting])
            c = np.fromiter(map(count, chain.from_iterable(waiting), repeat(0)), np.float64, int(sizes.sum()))
            y, f = features([codes.of(t) for t in waiting])
            parts = [choices(y[k : k + STEP], f[:, k : k + STEP]) for k in range(0, len(y), STEP)]
            logs = np.concatenate([sum(log_probs(weights, *choice) for choice in part) for part in parts]).astype(np.float64)
            inside = np.log(c + SMOOTHING) - per_member[y]
            first = np.cumsum(sizes) - sizes
            n_tokens += sizes.tolist()
            n_known += np.add.reduceat((c > 0).astype(np.int64), first).tolist()
            base += np.add.reduceat(np.log10((c + SMOOTHING) / (n_all + SMOOTHING * (v_all + 1))), first).tolist()
            score += (np.add.reduceat(logs + inside, first) / np.log(10)).tolist()
            waiting = []
        return pa.table(
            [texts.column("_x_id"), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array([n_all] * len(source), pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())],
            names=[id_col, "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    id_kind = df.schema[id_col].dataType.simpleString()
    return (
        blocks.select("_x_id", "_x_text", "block").groupBy("block").cogroup(answers.groupBy("block"))
        .applyInArrow(run, f"`{id_col}` {id_kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    )

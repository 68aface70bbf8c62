"""Hierarchical multi-length packing of documents into sequences.

Whole windows of a long document go out at once. What remains of each document is routed to the smallest context-size tier
that holds it. Every tier then opens a window per remainder, longest tier first, and fills the gap from all tiers: the largest
remainder that fits goes in whole; where none fits, the shortest is cut where the window ends. A finished window is full, so
only the end of a task leaves a part of a window; it goes out as full windows of smaller powers of two. The sequences of a
tier are dealt to step groups in serpentine order of their attention cost, so the groups of a batch cost about the same.

Packing needs no shuffle: each input partition is packed where it is tokenized, batch by batch, and between batches a task
holds, for each tier, less than one window of tokens and less than one step group of finished windows, as ids of their own
without the rest of their documents.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import byte_bpe
from .shared import by_characters

TIERS = (2048, 1024, 512, 256)
END_ID = 1
STEP_SEQUENCES = 32
LENGTH = itemgetter(2)
#: Of texts that a task holds as Python values at a time, or one text.
BATCH_CHARS = 8_000_000


class Packer:
    """Packs the remainders of one task. A piece is (document, start, length); a document is (id, ids, number of ids, place of the
    first of the ids held). Every tier keeps its pieces by length."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = sorted(tiers, reverse=True)
        self.pools: dict[int, list] = {t: [] for t in self.tiers}
        self.out: list[tuple[int, list]] = []  # (window, pieces)

    def _put(self, piece) -> None:
        bisect.insort(self.pools[next(t for t in reversed(self.tiers) if t >= piece[2])], piece, key=LENGTH)

    def add(self, doc) -> None:
        top, n = self.tiers[0], doc[2]
        whole = n // top
        self.out += [(top, [(doc, k * top, top)]) for k in range(whole)]
        if n % top:
            self._put((doc, whole * top, n % top))

    def _filler(self, gap: int):
        """A piece of at most gap tokens: the longest of all that fits whole, else the start of the shortest."""
        shortest = None
        for t in self.tiers:
            pool = self.pools[t]
            if pool:
                if fits := bisect.bisect_right(pool, gap, key=LENGTH):
                    return pool.pop(fits - 1)
                shortest = pool
        if shortest is None:
            return None
        doc, start, length = shortest.pop(0)
        self._put((doc, start + gap, length - gap))
        return doc, start, gap

    def release(self) -> None:
        """Let go of the documents whose pieces wait: each keeps its own ids alone."""

        def own(piece):
            (doc, ids, n, first), start, length = piece
            return (doc, bytes(ids[4 * (start - first) : 4 * (start - first + length)]), n, start), start, length

        self.pools = {t: [own(p) for p in pool] for t, pool in self.pools.items()}
        self.out = [(window, [own(p) for p in pieces]) for window, pieces in self.out]

    def pack(self) -> None:
        """Fill windows tier by tier while there is enough to fill them; what is left stays for the next batch."""
        held = sum(p[2] for pool in self.pools.values() for p in pool)
        for window in self.tiers:
            while self.pools[window] and held >= window:
                pieces = [self.pools[window].pop()]
                gap = window - pieces[0][2]
                while gap:
                    pieces.append(self._filler(gap))
                    gap -= pieces[-1][2]
                self.out.append((window, pieces))
                held -= window

    def finish(self) -> None:
        """Put what is left in a row and cut it into full windows of powers of two."""
        row = [p for t in self.tiers for p in self.pools[t]]
        self.pools = {t: [] for t in self.tiers}
        left = sum(p[2] for p in row)
        row.reverse()
        while left:
            window = min(self.tiers[0], 1 << (left.bit_length() - 1))
            pieces, gap = [], window
            while gap:
                doc, start, length = row.pop()
                if length > gap:
                    row.append((doc, start + gap, length - gap))
                    length = gap
                pieces.append((doc, start, length))
                gap -= length
            self.out.append((window, pieces))
            left -= window

    def taken(self, size: int) -> list[tuple[int, list]]:
        """The finished windows that make up whole step groups of size; the others of a tier wait for more, at most size - 1."""
        count = {t: sum(w == t for w, _ in self.out) // size * size for t in {w for w, _ in self.out}}
        out, rest = [], []
        for window in self.out:
            (out if count[window[0]] > 0 else rest).append(window)
            count[window[0]] -= 1
        self.out = rest
        return out


def _step_of(windows: list[tuple[int, list]], size: int) -> list[tuple[int, int]]:
    """(tier, number of the step group within this batch and tier) of each window."""
    steps = [(0, 0)] * len(windows)
    for tier in {w for w, _ in windows}:
        own = sorted((i for i, (w, _) in enumerate(windows) if w == tier), key=lambda i: -sum(p[2] ** 2 for p in windows[i][1]))
        groups = -(-len(own) // size)
        for k, i in enumerate(own):
            lap, place = divmod(k, groups)
            steps[i] = (tier, place if lap % 2 == 0 else groups - 1 - place)
    return steps


def pack_documents(
    df: DataFrame, tokenizer_path: str, tiers: tuple[int, ...] = TIERS, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, step_sequences: int = STEP_SEQUENCES, with_ids: bool = False, added_tokens: bool = True,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window, step_id and, with_ids, ids.

    Strings of the vocabulary's added tokens become their ids, as in the tokenizers library, unless added_tokens is false.
    Every id lies in exactly one piece and every sequence is full, its length a power of two up to the largest tier.
    Defined cases: a null or empty text is the end id alone; ids may be null or repeated, each row is a document of its
    own; an empty table gives no piece; other columns of df are ignored.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    fields = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, window int, step_id bigint"
    end = np.array([end_id], dtype=np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 36
        packer, made, made_steps = Packer(tiers), 0, 0
        bpe = byte_bpe.load(tokenizer_path)

        def emit(size: int) -> pa.RecordBatch | None:
            nonlocal made, made_steps
            windows = packer.taken(size)
            if not windows:
                return None
            steps = _step_of(windows, step_sequences)
            numbers = {s: made_steps + k for k, s in enumerate(sorted(set(steps)))}
            rows = []
            for (window, pieces), step in zip(windows, steps):
                offset = 0
                for (doc, ids, n, first), start, length in pieces:
                    part = ids[4 * (start - first) : 4 * (start - first + length)]
                    row = (doc, start, length, zlib.crc32(part), n, base + made, offset, window, base + numbers[step])
                    rows.append((*row, np.frombuffer(part, np.uint32)) if with_ids else row)
                    offset += length
                made += 1
            made_steps += len(numbers)
            columns = list(zip(*rows))
            kinds = [id_kind, *[pa.int64()] * 6, pa.int32(), pa.int64(), *[pa.list_(pa.int32())] * with_ids]
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)

        names = [id_col, *[f.split()[0] for f in fields.split(", ")], *["ids"] * with_ids]
        id_kind = pa.int64()
        for batch in by_characters(batches, 1, BATCH_CHARS):
            id_kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = memoryview(bpe.encode(text or "", added_tokens) + end)
                packer.add((doc, ids, len(ids) // 4, 0))
            packer.pack()
            if out := emit(step_sequences):
                yield out
            packer.release()
        packer.finish()
        if out := emit(1):
            yield out

    slim = df.select(F.col(id_col), F.col(text_col).cast("string").alias("_x_text"))
    return slim.mapInArrow(run, f"`{id_col}` {id_type}, {fields}" + ", ids array<int>" * with_ids)

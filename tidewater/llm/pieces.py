"""SentencePiece (BPE with byte fallback) encoding with seeded merge dropout, and decoding.

The merge agenda takes, again and again, the best-ranked candidate merge of a segment (leftmost among equals). With dropout,
a candidate is skipped for good when a keyed hash of (seed, document id, place of the segment in its text, the candidate's
place in the segment) falls below the rate: the same seed gives the same pieces everywhere and after any retry, every
occurrence of a word draws anew, and all segmentations decode to the same text.

Blanks never lie inside a piece after other characters, so a text falls apart into segments, a run of blanks and what
follows it. The distinct segments of a batch are merged once without dropout, which also tells what merges the agenda takes.
An occurrence for which none of those merges is skipped has that very segmentation; only the others are merged again, each
with its own skips. Segments of similar length are merged together, one step for all of them at a time, and segments longer
than WIDE by an agenda on a heap; both give the same pieces.
"""

from __future__ import annotations

import functools
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_characters
from .shingles import mix, mix_int

META = "▁"
WIDE = 64
_SEGMENT = re.compile(" +[^ ]*")
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_KI = _K.tolist()
_LAST = np.iinfo(np.int32).max


def _place(start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    """What the hash of a candidate takes from where it lies."""
    return (start.astype(np.uint64) * _K[0]) ^ (middle.astype(np.uint64) * _K[1]) ^ (end.astype(np.uint64) * _K[2])


def _skipped(keys: np.ndarray, places: np.ndarray, rate: float) -> np.ndarray:
    if rate >= 1:
        return np.ones(len(keys), bool)
    return (mix(keys ^ places) >> np.uint64(1)) < np.uint64(rate * 2**63)


class Pieces:
    """The model's pieces and its table of merges (left, right) -> (rank, merged)."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        normal = [k for k in range(self.size) if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k) or sp.is_unused(k))]
        # blanks stand for the meta symbol here, so a literal meta symbol in a text is an unknown character
        self.text = {k: sp.id_to_piece(k).replace(META, " ") for k in normal}
        of = {t: k for k, t in self.text.items()}
        # a character without a piece is a symbol of its own, beyond the pieces
        self.of_char = np.arange(0x110000, dtype=np.int32) + self.size
        for t, k in of.items():
            if len(t) == 1:
                self.of_char[ord(t)] = k
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.raw = {k: t.encode() for k, t in self.text.items()} | {int(k): bytes([b]) for b, k in enumerate(self.byte_ids)}
        rank = {s: r for r, s in enumerate(sorted({sp.get_score(k) for k in normal}, reverse=True))}
        merges = {}
        for whole, t in self.text.items():
            for cut in range(1, len(t)):
                left, right = of.get(t[:cut]), of.get(t[cut:])
                if left is not None and right is not None:
                    merges[left * self.size + right] = (rank[sp.get_score(whole)], whole)
        self.bits = int(len(merges) * 4).bit_length()
        self.table = np.full(1 << self.bits, -1, np.int64)
        self.ranks, self.merged = np.zeros(1 << self.bits, np.int32), np.zeros(1 << self.bits, np.int32)
        for key in sorted(merges):
            slot = int(self._slot(np.array([key]))[0])
            while self.table[slot] >= 0:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.table[slot] = key
            self.ranks[slot], self.merged[slot] = merges[key]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _K[0]) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair's merge, -1 where there is none."""
        keys = left.astype(np.int64) * self.size + right
        keys[(left >= self.size) | (right >= self.size)] = -2
        slot = self._slot(keys)
        at = self.table[slot]
        open_ = np.flatnonzero((at != keys) & (at >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            at[open_] = self.table[slot[open_]]
            open_ = open_[(at[open_] != keys[open_]) & (at[open_] >= 0)]
        slot[at != keys] = -1
        return slot

    def _merge_wide(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keys: np.ndarray | None, rate: float):
        """Merge rows of flat (all of at most a common small width) step by step. Returns (row, symbol) of what is left, by
        row and place, and (row, place) of the merges taken."""
        n, w = len(starts), int(lengths.max())
        at = np.arange(w)[:, None]
        inside = at < lengths
        sym = np.where(inside, flat[np.minimum(starts + at, len(flat) - 1)], 0).astype(np.int32)
        rows, size = np.arange(n), lengths.astype(np.int32)
        follow = np.where(at + 1 < lengths, at + 1, w).astype(np.int32)  # place of the next symbol; w: none
        before = np.repeat(np.arange(-1, w - 1, dtype=np.int32)[:, None], n, axis=1)
        own = keys
        cost, into = np.full((w, n), _LAST, np.int32), np.zeros((w, n), np.int32)
        left, taken = [], []

        def look(place: np.ndarray, col: np.ndarray) -> None:
            """Rank the candidates of the symbols at place, which have a next one."""
            mid = follow[place, col]
            slot = self.find(sym[place, col], sym[mid, col])
            hit = np.flatnonzero(slot >= 0)
            if own is not None and len(hit):
                p, c, m = place[hit], col[hit], mid[hit]
                hit = hit[~_skipped(own[c], _place(p, m, np.minimum(follow[m, c], size[c])), rate)]
            p, c, slot = place[hit], col[hit], slot[hit]
            cost[p, c], into[p, c] = self.ranks[slot] * w + p, self.merged[slot]

        p, c = np.nonzero(at + 1 < lengths)
        look(p, c)
        while n:
            best = cost.min(axis=0)
            live = best < _LAST
            count = int(live.sum())
            if count < 0.8 * n:
                over = np.flatnonzero(~live)
                c, p = np.nonzero(inside[:, over].T)
                left.append((rows[over[c]], sym[p, over[c]]))
                keep = np.flatnonzero(live)
                sym, follow, before, cost, into, inside = (x[:, keep] for x in (sym, follow, before, cost, into, inside))
                rows, size, best, n = rows[keep], size[keep], best[keep], count
                own = own[keep] if own is not None else None
                c = np.arange(n)
            else:
                c = np.flatnonzero(live)
                best = best[c]
            if not len(c):
                continue
            p = best % w
            mid = follow[p, c]
            after = follow[mid, c]
            if own is None:
                taken.append((rows[c], _place(p, mid, np.minimum(after, size[c]))))
            sym[p, c], follow[p, c] = into[p, c], after
            cost[mid, c], inside[mid, c], cost[p, c] = _LAST, False, _LAST
            more = after < w
            before[after[more], c[more]] = p[more]
            prior = before[p, c]
            some = prior >= 0
            cost[prior[some], c[some]] = _LAST
            look(np.concatenate([p[more], prior[some]]), np.concatenate([c[more], c[some]]))
        order = [np.concatenate(x) for x in zip(*left)]
        sort = np.argsort(order[0], kind="stable")
        return order[0][sort], order[1][sort], [np.concatenate(x) for x in zip(*taken)] if taken else [np.zeros(0, np.int64), np.zeros(0, np.uint64)]

    def _merge_long(self, sym: np.ndarray, key: np.uint64 | None, rate: float) -> np.ndarray:
        """The symbols left of one segment, by an agenda on a heap."""
        n = len(sym)
        symbols, follow, before = sym.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int, int]] = []  # rank, start, middle, end, merged

        def look(start: np.ndarray, middle: np.ndarray, end: np.ndarray, left: np.ndarray, right: np.ndarray) -> list:
            slot = self.find(left, right)
            hit = np.flatnonzero(slot >= 0)
            if key is not None and len(hit):
                hit = hit[~_skipped(np.full(len(hit), key), _place(start[hit], middle[hit], end[hit]), rate)]
            return list(zip(self.ranks[slot[hit]].tolist(), start[hit].tolist(), middle[hit].tolist(), end[hit].tolist(), self.merged[slot[hit]].tolist()))

        at = np.arange(n - 1)
        agenda = look(at, at + 1, at + 2, sym[:-1], sym[1:])
        heapq.heapify(agenda)
        find = self._one
        while agenda:
            _, start, middle, end, merged = heapq.heappop(agenda)
            if symbols[start] < 0 or follow[start] != middle or middle >= n or symbols[middle] < 0 or follow[middle] != end:
                continue  # a symbol of it has been merged meanwhile
            symbols[start], symbols[middle], follow[start] = merged, -1, end
            if end < n:
                before[end] = start
                if found := find(merged, symbols[end], start, end, follow[end], key, rate):
                    heapq.heappush(agenda, found)
            if (prior := before[start]) >= 0:
                if found := find(symbols[prior], merged, prior, start, end, key, rate):
                    heapq.heappush(agenda, found)
        return np.array([s for s in symbols if s >= 0], np.int32)

    @functools.cached_property
    def _merges(self) -> dict[int, tuple[int, int]]:
        used = np.flatnonzero(self.table >= 0)
        return dict(zip(self.table[used].tolist(), zip(self.ranks[used].tolist(), self.merged[used].tolist())))

    def _one(self, left: int, right: int, start: int, middle: int, end: int, key, rate: float):
        if left >= self.size or right >= self.size or (found := self._merges.get(left * self.size + right)) is None:
            return None
        if key is not None and (rate >= 1 or mix_int(int(key) ^ (start * _KI[0] ^ middle * _KI[1] ^ end * _KI[2])) >> 1 < int(rate * 2**63)):
            return None
        return found[0], start, middle, end, found[1]

    def merge(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keys: np.ndarray | None = None, rate: float = 0.0):
        """Merge the segments flat[start : start + length]: (symbols of all in a row, number of each, merges taken).

        keys: what dropout hashes besides a candidate's place; None: no dropout, and the merges taken of segments up to WIDE
        are returned as (segment, place), ordered by segment.
        """
        rows, symbols, taken_rows, places = [], [], [], []
        done = 0
        for width in (2, 4, 6, 8, 12, 16, 32, WIDE):
            of = np.flatnonzero((lengths > done) & (lengths <= width))
            done = width
            if len(of):
                r, s, (tr, tp) = self._merge_wide(flat, starts[of], lengths[of], None if keys is None else keys[of], rate)
                rows.append(of[r])
                symbols.append(s)
                taken_rows.append(of[tr])
                places.append(tp)
        for k in np.flatnonzero(lengths > WIDE).tolist():
            s = self._merge_long(flat[starts[k] : starts[k] + lengths[k]], None if keys is None else keys[k], rate)
            rows.append(np.full(len(s), k))
            symbols.append(s)
        if not rows:
            return np.zeros(0, np.int32), np.zeros(len(lengths), np.int64), (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        row, symbol = np.concatenate(rows), np.concatenate(symbols)
        order = np.argsort(row, kind="stable")
        taken = np.concatenate([*taken_rows, np.zeros(0, np.int64)])
        by = np.argsort(taken, kind="stable")
        return symbol[order], np.bincount(row, minlength=len(lengths)), (taken[by], np.concatenate([*places, np.zeros(0, np.uint64)])[by])

    def spell(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each segment): characters that the model doesn't know become the pieces of their bytes."""
        strange = np.flatnonzero(symbols >= self.size)
        if not len(strange):
            return symbols, counts
        chars, which = np.unique(symbols[strange], return_inverse=True)
        spelled = [chr(c - self.size).encode("utf-8", "replace") for c in chars.tolist()]
        own = np.fromiter(map(len, spelled), np.int64, len(spelled))
        data = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        sizes = np.ones(len(symbols), np.int64)
        sizes[strange] = own[which]
        ends = np.cumsum(sizes)
        ids = np.empty(int(ends[-1]), np.int32)
        ids[ends - sizes] = symbols
        for k in range(int(own.max())):
            longer = np.flatnonzero(own[which] > k)
            ids[(ends - sizes)[strange[longer]] + k] = data[(np.cumsum(own) - own)[which[longer]] + k]
        of = np.repeat(np.arange(len(counts)), counts)
        return ids, np.bincount(of, sizes, minlength=len(counts)).astype(np.int64)

    def decode(self, ids) -> str:
        """The text of ids: blanks for the meta symbol, bytes for byte pieces, without the blank put before a text."""
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")[1:]

    def encode_batch(self, texts: list[str], own_keys: list[int], seed: int, rate: float) -> list[np.ndarray]:
        """Ids of each text; own_keys vary the dropout between texts, and a segment's place varies it inside one."""
        if not texts:
            return []
        index: dict[str, int] = {}
        number = index.setdefault
        found = [np.array([number(s, len(index)) for s in _SEGMENT.findall(" " + t)], np.int64) if t else np.zeros(0, np.int64) for t in texts]
        counts = np.array([len(f) for f in found], np.int64)
        of = np.concatenate(found)
        lengths = np.fromiter(map(len, index), np.int64, len(index))
        flat = self.of_char[np.frombuffer("".join(index).encode("utf-32-le", "surrogatepass"), np.uint32)]
        starts = np.cumsum(lengths) - lengths
        symbols, sizes, (taken, places) = self.merge(flat, starts, lengths)
        ids, sizes = self.spell(symbols, sizes)
        which = of
        if rate > 0 and len(of):
            place = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
            keys = mix(np.repeat(np.array([k & (2**64 - 1) for k in own_keys], np.uint64) + np.uint64((seed & (2**63 - 1)) * int(_K[2]) & (2**64 - 1)), counts) + place.astype(np.uint64) * _K[0])
            # an occurrence keeps the common segmentation unless one of the merges behind it is skipped
            per = np.bincount(taken, minlength=len(lengths))
            again = lengths[of] > WIDE
            some = np.flatnonzero(per[of] > 0)
            for part in np.array_split(some, 1 + len(some) // 200_000):
                if len(part):
                    m = per[of[part]]
                    first = np.cumsum(m) - m
                    at = np.arange(int(m.sum())) + np.repeat((np.cumsum(per) - per)[of[part]] - first, m)
                    again[part] = np.logical_or.reduceat(_skipped(np.repeat(keys[part], m), places[at], rate), first)
            redo = np.flatnonzero(again)
            if len(redo):
                more, more_sizes = self.spell(*self.merge(flat, starts[of[redo]], lengths[of[redo]], keys[redo], rate)[:2])
                which = of.copy()
                which[redo] = len(sizes) + np.arange(len(redo))
                ids, sizes = np.concatenate([ids, more]), np.concatenate([sizes, more_sizes])
        begin = (np.cumsum(sizes) - sizes)[which]
        own = sizes[which]
        out = ids[np.arange(int(own.sum())) + np.repeat(begin - (np.cumsum(own) - own), own)]
        ends = np.append(0, np.cumsum(own))[np.append(0, np.cumsum(counts))]
        return [out[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


@functools.cache
def load(path: str) -> Pieces:
    return Pieces(path)


#: Texts that are merged together: so many characters at most, or one text.
BATCH_CHARS = 2_000_000


def encode_pieces(df: DataFrame, model_path: str, seed: int = 0, rate: float = 0.1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ids (array), n_pieces, ids_crc32 (little-endian 32-bit ids), lossless (decoded again and compared).

    rate 0 gives the model's own segmentation. Defined cases: null and empty texts have no ids; literal meta symbols (U+2581)
    and characters without a piece are spelled in byte pieces, so decoding returns every text exactly; a null id varies like
    the id's empty text; repeated rows get equal ids; an empty table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in by_characters(batches, 1, BATCH_CHARS):
            own = [t or "" for t in batch.column(1).to_pylist()]
            keys = [xxhash.xxh3_64_intdigest("" if n is None else str(n), seed) for n in batch.column(0).to_pylist()]
            out = model.encode_batch(own, keys, seed, rate)
            ends = np.cumsum([0, *map(len, out)])
            flat = np.concatenate([*out, np.zeros(0, np.int32)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                    pa.array(np.diff(ends), pa.int64()), pa.array([zlib.crc32(o.astype("<u4").tobytes()) for o in out], pa.int64()),
                    pa.array([model.decode(o.tolist()) == t for o, t in zip(out, own)], pa.bool_()),
                ],
                names=[id_col, "ids", "n_pieces", "ids_crc32", "lossless"],
            )

    slim = df.select(F.col(id_col), F.col(text_col).cast("string").alias("_x_text"))
    kind = df.schema[id_col].dataType.simpleString()
    return slim.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, n_pieces bigint, ids_crc32 bigint, lossless boolean")


def decode_pieces(df: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """df with out_col, the text of ids_col; null ids give a null text."""

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load(model_path)
        for arrays in batches:
            yield arrays.map(lambda a: None if a is None else model.decode([int(k) for k in a]))

    return df.withColumn(out_col, decoded(F.col(ids_col)))

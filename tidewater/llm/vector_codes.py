"""Product codes of integer vectors, trained and assigned without floating point.

Vectors become integers, are cut into equal parts, and every part is replaced by the index of its codebook's nearest entry.
Parts and entries are padded with zeros to a power of two P and transformed by the Walsh-Hadamard transform, whose rows are
taken in sequency order (by sign changes). The transform of a difference has P times its squared length, so sums of scaled
squared differences over the first coefficients only grow: an entry whose sum exceeds the whole sum of another one is out. The
coefficients of few sign changes hold most of a smooth difference, so most entries go after one or two of them. All numbers are
integers; results don't depend on how rows are split into tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize

#: Rows that a task holds as arrays at a time.
ROWS = 1024
#: Components above it are no longs with room for sums.
LARGEST = float(1 << 62)


def sequency(size: int) -> np.ndarray:
    """Places of the transform's rows, as transform() returns them, by ascending number of sign changes."""
    rows = transform(np.eye(size, dtype=np.int64))
    return np.argsort((rows[:-1] != rows[1:]).sum(0), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows of x, whose length is a power of two, by additions alone; in natural order."""
    x, half = x.copy(), 1
    while half < x.shape[1]:
        y = x.reshape(len(x), -1, 2, half)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), -1)
        half *= 2
    return x


def spectrum(x: np.ndarray) -> np.ndarray:
    """Coefficients in sequency order of rows padded with zeros to a power of two."""
    size = 1 << (x.shape[1] - 1).bit_length()
    padded = np.zeros((len(x), size), x.dtype)
    padded[:, : x.shape[1]] = x
    return transform(padded)[:, sequency(size)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance to it) of every part; ties to the lower index."""
    t, e = spectrum(parts), spectrum(entries)
    sums = (t[:, :1] - e[:, 0]) ** 2
    guess = np.argmin(sums, axis=1)
    most = ((t - e[guess]) ** 2).sum(axis=1)  # the whole sum of one entry: the nearest has no more
    of, entry = np.nonzero(sums <= most[:, None])
    sums = sums[of, entry]
    for k in range(1, t.shape[1]):
        sums = sums + (t[of, k] - e[entry, k]) ** 2
        stays = sums <= most[of]
        of, entry, sums = of[stays], entry[stays], sums[stays]
    first = np.searchsorted(of, np.arange(len(t)))
    least = np.minimum.reduceat(sums, first) if len(t) else sums
    at = np.flatnonzero(sums == least[of])
    at = at[np.searchsorted(of[at], np.arange(len(t)))]
    return entry[at], least // t.shape[1]


class Codec:
    """Integer vectors of one length cut into equal parts, padded with zeros at the end where the length leaves a remainder."""

    def __init__(self, length: int, parts: int):
        self.length, self.parts = length, parts
        self.width = -(-length // parts)
        #: Up to this magnitude of components the scaled sums of squared differences are exact in 64 bits.
        self.fast = math.isqrt((1 << 62) // (self.width << (self.width - 1).bit_length())) // 2

    def integers(self, values: np.ndarray) -> np.ndarray:
        """floor(256 * x) cut into (row, part, component); Python's integers where 64 bits might not hold the sums."""
        scaled = np.floor(values.astype(np.float64) * 256.0)
        fast = not scaled.size or np.abs(scaled).max() <= self.fast
        whole = scaled.astype(np.int64) if fast else np.array([[int(c) for c in row] for row in scaled.tolist()], dtype=object).reshape(scaled.shape)
        cut = np.zeros((len(values), self.parts * self.width), whole.dtype)
        cut[:, : self.length] = whole
        return cut.reshape(len(values), self.parts, self.width)

    def book(self, entries: list[list[int]]) -> np.ndarray:
        """Entries as 64-bit integers if sums stay exact, else as Python's."""
        top = max((abs(c) for entry in entries for c in entry), default=0)
        return np.array(entries, dtype=np.int64 if top <= self.fast else object).reshape(len(entries), self.width)

    def assign(self, cut: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for p, book in enumerate(books):
            kind = np.int64 if cut.dtype == book.dtype == np.int64 else object
            found.append(nearest(cut[:, p].astype(kind), book.astype(kind)))
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _chunks(batches: Iterator[pa.RecordBatch], codec: Codec) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows with their vectors as integers, so many at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            values = part.column(part.schema.get_field_index("_x_v")).flatten().to_numpy(zero_copy_only=False)
            yield part, codec.integers(values.reshape(part.num_rows, codec.length))


def _sums(rows: DataFrame, codec: Codec, books: list[np.ndarray]) -> dict[tuple[int, int], tuple[list[int], int]]:
    """(part, entry) -> sums by component and count of the parts that are nearest to the entry. Every task adds up its own rows;
    what is shuffled and collected has parts * entries * width rows at most, whatever the table's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(b), codec.width), dtype=object) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for _, cut in _chunks(batches, codec):
            index, _ = codec.assign(cut, books)
            for p in range(codec.parts):
                order = np.argsort(index[:, p], kind="stable")
                used, start = np.unique(index[order, p], return_index=True)
                sums[p][used] += np.add.reduceat(cut[order, p], start, axis=0).astype(object)
                counts[p] += np.bincount(index[:, p], minlength=len(counts[p]))
        found = [(p, int(e), w, Decimal(int(sums[p][e, w])), int(counts[p][e])) for p in range(codec.parts) for e in np.flatnonzero(counts[p]) for w in range(codec.width)]
        columns = list(zip(*found)) or [[]] * 5
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["part", "entry", "place", "total", "n"])

    partial = rows.select("_x_v").mapInArrow(run, "part int, entry int, place int, total decimal(38,0), n bigint")
    found: dict[tuple[int, int], tuple[list[int], int]] = {}
    for r in partial.groupBy("part", "entry", "place").agg(F.sum("total").cast("decimal(38,0)").alias("total"), F.sum("n").alias("n")).collect():
        found.setdefault((r.part, r.entry), ([0] * codec.width, r.n))[0][r.place] = int(r.total)
    return found


def vector_codes(
    df: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """One row per kept row: id, code (two hex digits per part), error (squared distances to the entries, summed over parts),
    label_error (errors summed over rows of an equal label, nulls together), codebooks_sha256 (of all final entries).

    Rows are kept whose vector is neither null nor empty and holds neither null nor non-finite components. Books start as the
    parts of the rows with the least ids; each round replaces an entry by the floored mean of its parts, unused ones stay.
    Defined cases: null ids come last among the starting rows, equal ids by ascending vector; repeated rows count each; fewer
    rows than entries give smaller books; rows whose vector has another length than the first starting row's, or a component of
    2 ** 54 or more, can't be coded and are dropped like null vectors; a length that the number of parts doesn't divide is padded
    with zeros at the end; a sum that exceeds a long is null; an empty table gives an empty result; other columns are ignored.
    """
    if entries > 256:
        raise ValueError("an index has two hex digits")
    clean = F.size("_x_v") > 0
    clean &= ~F.exists("_x_v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) * 256.0 >= LARGEST))
    given = df.select(F.col(id_col).alias("_x_id"), F.col(label_col).alias("_x_label"), F.col(vector_col).alias("_x_v"))
    kept = given.filter(F.col("_x_v").isNotNull()).filter(F.coalesce(clean, F.lit(False)))
    start = [list(r[0]) for r in kept.orderBy(F.col("_x_id").asc_nulls_last(), "_x_v").select("_x_v").limit(entries).collect()]
    length = len(start[0]) if start else parts
    start = [v for v in start if len(v) == length]
    rows = kept.filter(F.size("_x_v") == length)
    codec = Codec(length, parts)
    first = codec.integers(np.array(start, dtype=np.float64).reshape(len(start), length))
    books = [codec.book(first[:, p].tolist()) for p in range(parts)]
    for _ in range(rounds if start else 0):
        found = _sums(rows, codec, books)
        means = [[[t // found[p, e][1] for t in found[p, e][0]] if (p, e) in found else old for e, old in enumerate(book.tolist())] for p, book in enumerate(books)]
        books = [codec.book(book) for book in means]
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book.tolist() for c in entry).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = np.array([f"{k:02x}" for k in range(256)])
        for part, cut in _chunks(batches, codec):
            index, error = codec.assign(cut, books)
            codes = ["".join(row) for row in digits[index].tolist()]
            totals = [t if t < 1 << 63 else None for t in error.sum(axis=1).tolist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(codes, pa.string()), pa.array(totals, pa.int64())], names=["_x_id", "_x_label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    coded = materialize(rows.mapInArrow(run, f"_x_id {kinds['_x_id']}, _x_label {kinds['_x_label']}, code string, error bigint"), "vector-codes")
    # one row per label, written first so that Spark knows its size when it picks the join
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint")
    totals = materialize(coded.groupBy(F.col("_x_label").alias("_x_of")).agg(total.alias("label_error")), "vector-labels")
    return coded.join(totals, F.col("_x_label").eqNullSafe(F.col("_x_of"))).select(
        F.col("_x_id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )

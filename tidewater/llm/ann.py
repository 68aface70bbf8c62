"""Nearest neighbours by cosine: inverted lists scanned dimension block by dimension block, with early abandonment.

Unit vectors are rotated at random, so that the first d of D dimensions of a difference are an unbiased sample of it. Every list
is kept in chunks of rows, column block by column block. A query scans a chunk's blocks in turn; after each block a hypothesis
test drops the candidates whose partial distance, carried on to all dimensions, exceeds the query's present k-th best by more
than chance allows: partial > r^2 * d/D * (1 + EPSILON / sqrt(d))^2. What is left is scored in double precision on the original
vectors. The nearest list is searched first; its k-th best starts the tests in all other probed lists.

Centroids and the number of probed lists are fitted on a bounded sample: so many lists that the sample's own neighbours are found
with RECALL. Every vector is indexed. Equal vectors are one candidate that carries its k + 1 least ids, which is all a result can
hold of them, so copies make no work. Lists of any size are dealt over chunks and shares.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .shared import materialize

#: Vectors, and bytes of them as doubles, that the index is fitted on.
SAMPLE, SAMPLE_BYTES = 16384, 1 << 25
#: Lists: a root of the number of vectors, but no more than sampled vectors allow.
PER_CENTROID = 16
ROUNDS = 8
#: Aimed at within the sample, for so many of its vectors as queries.
RECALL, TRIED = 0.995, 512
#: Dimensions of a column block, and the width of the test.
BLOCK, EPSILON = 16, 2.1
#: Rows of a chunk, queries of a block, chunks of a share, and rows that a task may hold back to fill chunks.
CHUNK, QUERIES, SHARE, HELD = 1024, 256, 32, 65536
#: Rows of one vector's queries that one task expands.
COPIES = 10000
SEED = 12


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


class Index:
    """Rotation, centroids of rotated unit vectors and number of probed lists, for vectors of one length."""

    def __init__(self, turn: np.ndarray, centroids: np.ndarray, probes: int):
        self.turn, self.centroids, self.probes = turn, centroids, probes

    @staticmethod
    def fit(sample: np.ndarray, count: int, k: int) -> Index:
        """From unit vectors of a sample of count vectors. Lloyd's rounds by inner product; a list that loses its members stays."""
        rng = np.random.default_rng(SEED)
        turn = np.linalg.qr(rng.standard_normal((sample.shape[1], sample.shape[1])))[0]
        rows = sample @ turn
        lists = int(max(1, min(round(count**0.5), len(rows) // PER_CENTROID)))
        centroids = rows[rng.permutation(len(rows))[:lists]]
        for _ in range(ROUNDS):
            own = np.argmax(rows @ centroids.T, axis=1)
            order = np.argsort(own, kind="stable")
            used, start = np.unique(own[order], return_index=True)
            sums = np.add.reduceat(rows[order], start, axis=0)
            size = np.sqrt((sums * sums).sum(axis=1))
            centroids = centroids.copy()
            centroids[used[size > 1e-9]] = (sums / np.maximum(size, 1e-9)[:, None])[size > 1e-9]
        asked = rows[rng.permutation(len(rows))[:TRIED]]
        near = np.argsort(-(asked @ rows.T), axis=1, kind="stable")[:, 1 : k + 1]
        place = np.argsort(np.argsort(-(asked @ centroids.T), axis=1, kind="stable"), axis=1)
        ranks = np.sort(np.take_along_axis(place, np.argmax(rows @ centroids.T, axis=1)[near], axis=1).ravel())
        probes = int(ranks[min(len(ranks) - 1, int(np.ceil(RECALL * len(ranks))) - 1)]) + 1 if len(ranks) else 1
        return Index(turn, centroids, min(lists, probes + 1))

    def nearest(self, v: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
        """(rotated unit vectors, their nearest lists) of original vectors."""
        rows = unit(v) @ self.turn
        scores = rows @ self.centroids.T
        if many >= scores.shape[1]:
            return rows, np.argsort(-scores, axis=1, kind="stable")
        top = np.argpartition(-scores, many - 1, axis=1)[:, :many]
        return rows, np.take_along_axis(top, np.argsort(-np.take_along_axis(scores, top, axis=1), axis=1, kind="stable"), axis=1)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, turn=self.turn, centroids=self.centroids, probes=self.probes)
        return out.getvalue()

    @staticmethod
    def load(raw: bytes) -> Index:
        with np.load(io.BytesIO(raw)) as f:
            return Index(f["turn"], f["centroids"], int(f["probes"]))


def scan(queries: np.ndarray, rows: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of the pairs that no test drops. queries, rows: rotated unit vectors; limits: squared distances."""
    dim = queries.shape[1]
    cuts = [slice(at, min(at + BLOCK, dim)) for at in range(0, dim, BLOCK)]
    q, r = queries[:, cuts[0]], rows[:, cuts[0]]
    part = (q * q).sum(axis=1)[:, None] + (r * r).sum(axis=1) - 2 * (q @ r.T)

    def test(done: int) -> np.ndarray:
        return limits * (done / dim * (1 + EPSILON / done**0.5) ** 2 if done < dim else 1.0) + 1e-9

    of, at = np.nonzero(part <= test(cuts[0].stop)[:, None])
    part = part[of, at]
    for cut in cuts[1:]:
        part = part + ((queries[of, cut] - rows[at, cut]) ** 2).sum(axis=1)
        stays = part <= test(cut.stop)[of]
        of, at, part = of[stays], at[stays], part[stays]
    return of, at


def _matrix(raws, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raws), kind).astype(np.float64).reshape(-1, dim)


def _usable(v: list | None, kind: str) -> bytes | None:
    """A vector's components as bytes; None where it takes no part. Doubles are scaled by a power of two against overflow, which
    changes no cosine."""
    x = np.array([np.nan if c is None else c for c in v or ()], dtype=np.float64)
    top = np.abs(x).max() if len(x) else 0.0
    if not (top > 0 and np.isfinite(top)):
        return None
    if kind == "<f8":
        x = np.ldexp(x, -int(np.frexp(top)[1]))
    return (x + 0.0).astype(kind).tobytes()


def _rows(rows: DataFrame, kind: str) -> DataFrame:
    """(own, vec) of the rows with usable vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = pa.array([_usable(v, kind) for v in batch.column(1).to_pylist()], pa.binary())
            found = pa.RecordBatch.from_arrays([batch.column(0), raws], names=["own", "vec"])
            yield found.filter(raws.is_valid())

    return rows.mapInArrow(run, f"own {rows.schema['_x_id'].dataType.simpleString()}, vec binary")


def _distinct(rows: DataFrame, kind: str, k: int) -> DataFrame:
    """(vec, ids): the usable vectors' bytes with their k + 1 least ids, merged in every task before anything is shuffled."""
    of = to_arrow_type(rows.schema["_x_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}

        def flush() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.list_(of))], names=["vec", "ids"])
            held.clear()
            return found

        for batch in batches:
            for own, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (raw := _usable(v, kind)) is None:
                    continue
                ids = held.setdefault(raw, [])
                if own not in ids:
                    ids.append(own)
                    if len(ids) > k + 1:
                        ids.remove(max(ids))
            if len(held) >= HELD:
                yield flush()
        yield flush()

    merged = rows.mapInArrow(run, f"vec binary, ids array<{rows.schema['_x_id'].dataType.simpleString()}>")
    return merged.groupBy("vec").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))


def _filled(batches: Iterator[pa.RecordBatch], lists_of, size: int, held_most: int) -> Iterator[tuple[int, pa.Table]]:
    """(list, rows) of up to size rows each; lists_of gives the rows' lists, one column of them per probe. No more than held_most
    rows wait for their chunk to fill, however many lists there are."""
    waiting: dict[int, list[pa.RecordBatch]] = {}
    counts: dict[int, int] = {}

    def take(own: int) -> Iterator[tuple[int, pa.Table]]:
        table = pa.Table.from_batches(waiting.pop(own))
        counts.pop(own)
        for at in range(0, table.num_rows, size):
            yield own, table.slice(at, size)

    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            lists = lists_of(part)
            for own in np.unique(lists).tolist():
                mine = part.take(pa.array(np.flatnonzero((lists == own).any(axis=1))))
                waiting.setdefault(own, []).append(mine)
                counts[own] = counts.get(own, 0) + mine.num_rows
                if counts[own] >= size:
                    yield from take(own)
            if sum(counts.values()) > held_most:
                for own in list(waiting):
                    yield from take(own)
    for own in list(waiting):
        yield from take(own)


def _search(blocks: DataFrame, chunks: DataFrame, sizes: DataFrame, raw: bytes, kind: str, dim: int, k: int) -> DataFrame:
    """(query, score, ids) of the k + 1 best candidates of every query block in every chunk of its list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = Index.load(raw).turn
        for batch in batches:
            for n in range(batch.num_rows):
                queries, vectors, limits, rows, ids = (batch.column(c)[n].as_py() for c in range(5))
                q, v = (np.frombuffer(x, kind).astype(np.float64).reshape(-1, dim) for x in (vectors, rows))
                uq, uv, most = unit(q) @ turn, unit(v) @ turn, np.array(limits)
                first = np.array([x[0] for x in ids])
                best: list[list[tuple]] = [[] for _ in queries]
                for at in [0, *range(64, len(v), 256)]:
                    to = min(len(v), 64 if at == 0 else at + 256)
                    of, row = scan(uq, uv[at:to], most)
                    row = row + at
                    a, b = q[of], v[row]
                    score = (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
                    order = np.lexsort((first[row], -score, of))
                    of, row, score = of[order], row[order], score[order]
                    start = np.searchsorted(of, np.arange(len(queries) + 1))
                    for i in range(len(queries)):
                        new = range(start[i], min(start[i + 1], start[i] + k + 1))
                        if len(new):
                            best[i] = sorted(best[i] + [(-score[j], first[row[j]], row[j]) for j in new])[: k + 1]
                            if len(best[i]) > k:
                                most[i] = min(most[i], 2 + 2 * best[i][-1][0] + 1e-9)
                found = [(own, float(-s), ids[r]) for own, top in zip(queries, best) for s, _, r in top]
                columns = list(zip(*found)) or [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.float64()), pa.array(columns[2], batch.column(4).type.value_type)], names=["query", "score", "ids"])

    shares = sizes.select("list", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    met = blocks.join(F.broadcast(shares), "list").join(chunks, ["list", "share"]).select("queries", "vectors", "limits", "rows", "ids")
    return met.mapInArrow(run, f"query bigint, score double, ids {chunks.schema['ids'].dataType.elementType.simpleString()}")


def _one_length(nodes: DataFrame, asked: DataFrame, count: int, kind: str, dim: int, k: int) -> DataFrame:
    """(query, found) for vectors of one length; found: the k + 1 best candidates (lost, ids), best first. lost: minus the score."""
    most = min(SAMPLE, max(256, SAMPLE_BYTES // (8 * dim)))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raws = sorted(x for b in batches for x in b.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([Index.fit(unit(_matrix(raws, kind, dim)), count, k).dump()], pa.binary())], names=["model"])

    sample = nodes.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(most)
    raw = bytes(sample.repartition(1).mapInArrow(fit, "model binary").first().model)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, made = Index.load(raw), 0
        lists_of = lambda part: index.nearest(_matrix(part.column(0).to_pylist(), kind, dim), 1)[1]
        for own, table in _filled(batches, lists_of, CHUNK, HELD):
            made += 1
            row = [[own], [made], [b"".join(table.column(0).to_pylist())], [table.column(1).to_pylist()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int64(), pa.int64(), pa.binary(), pa.list_(table.schema.field(1).type)))], names=["list", "made", "rows", "ids"])

    of = nodes.schema["ids"].dataType.simpleString()
    chunks = materialize(nodes.select("vec", "ids").mapInArrow(file, f"list bigint, made bigint, rows binary, ids array<{of}>").withColumn("_x_part", F.spark_partition_id()), "ann-chunks")
    # a row per list, of which there are SAMPLE / PER_CENTROID at most
    sizes = materialize(chunks.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("shares")), "ann-lists")
    chunks = chunks.join(F.broadcast(sizes), "list").withColumn("share", F.pmod(F.hash("_x_part", "made"), F.col("shares")))

    def blocks(of_rank: slice):
        """Blocks of queries per list, for the lists of those ranks by nearness."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index.load(raw)

            def lists_of(part: pa.RecordBatch) -> np.ndarray:
                many = len(index.centroids) if of_rank.stop is None else min(of_rank.stop, len(index.centroids))
                return index.nearest(_matrix(part.column(1).to_pylist(), kind, dim), many)[1][:, of_rank]

            for own, table in _filled(batches, lists_of, QUERIES, HELD):
                row = [[own], [table.column(0).to_pylist()], [b"".join(table.column(1).to_pylist())], [table.column(2).to_pylist()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.float64())))], names=["list", "queries", "vectors", "limits"])

        return run

    shape = "list bigint, queries array<bigint>, vectors binary, limits array<double>"

    def search(queries: DataFrame, of_rank: slice, name: str) -> DataFrame:
        return materialize(_search(queries.select("query", "vec", "limit").mapInArrow(blocks(of_rank), shape), chunks, sizes, raw, kind, dim, k), name)

    def best(found: DataFrame) -> DataFrame:
        entry = F.struct((-F.col("score")).alias("lost"), "ids")
        return found.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(entry)), 1, k + 1).alias("found"))

    far = F.lit(8.0)  # more than any squared distance
    limit = F.when(F.size("found") > k, F.lit(2.0) + 2 * F.element_at("found", k + 1)["lost"] + 1e-9).otherwise(far)
    near = search(asked.withColumn("limit", far), slice(0, 1), "ann-near")
    bounded = asked.join(best(near).select("query", limit.alias("limit")), "query", "left").withColumn("limit", F.coalesce("limit", far))
    probes = Index.load(raw).probes
    found = materialize(best(near.unionByName(search(bounded, slice(1, probes), "ann-far"))), "ann-found") if probes > 1 else best(near)
    # where so few vectors lie in the probed lists, all lists are searched
    short = asked.join(found.filter(F.size("found") > min(k, count - 1)), "query", "left_anti")
    if short.isEmpty():
        return found
    return found.join(short, "query", "left_anti").unionByName(best(search(short.withColumn("limit", far), slice(0, None), "ann-rest")))


def nearest_neighbours(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """k rows for each query, fewer only where there are fewer candidates: query_id, rank (from 1), vec_id, score; nearest first,
    ties to smaller ids.

    Queries are the rows where is_query holds; candidates are all rows with another id. score is the cosine in double
    precision of the original vectors. The neighbours are the nearest of those in the probed lists. Defined cases: vectors
    that are null, empty, zero or hold null or non-finite components and rows without an id take no part; only vectors of
    the query's length are its candidates; rows equal in id and vector count once; a repeated id is a query with each of its
    vectors and never its own candidate; an empty table gives an empty result; other columns are ignored.
    """
    kind = "<f4" if df.schema[vector_col].dataType.elementType.simpleString() == "float" else "<f8"
    picked = (F.col(id_col).alias("_x_id"), F.col(vector_col).alias("_x_v"))
    nodes = materialize(_distinct(df.select(*picked).filter("_x_id is not null"), kind, k), "ann-vectors")
    own = materialize(_rows(df.filter(is_query).select(*picked).filter("_x_id is not null"), kind).distinct(), "ann-queries")
    counts = materialize(own.groupBy("vec").agg(F.count(F.lit(1)).alias("n")).withColumn("query", F.monotonically_increasing_id()), "ann-asked")
    # vectors that more than a thousandth of all queries share, so a thousand at most, have their queries dealt over shares
    most = max(COPIES, own.count() // 1000)
    hot = F.broadcast(counts.filter(F.col("n") > most).select("vec", F.ceil(F.col("n") / most).cast("int").alias("shares")))
    own = own.join(hot, "vec", "left").withColumn("share", F.coalesce(F.pmod(F.hash("own"), "shares"), F.lit(0)))
    asked = counts.select("query", "vec", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / most).cast("int"), F.lit(1)) - 1)).alias("share"))

    width = np.dtype(kind).itemsize
    lengths = nodes.groupBy(F.octet_length("vec").alias("bytes")).count().collect()
    parts = [_one_length(nodes.filter(F.octet_length("vec") == r["bytes"]), counts.filter(F.octet_length("vec") == r["bytes"]), r["count"], kind, r["bytes"] // width, k) for r in lengths]
    kinds = f"query bigint, found array<struct<lost:double,ids:{nodes.schema['ids'].dataType.simpleString()}>>"
    found = reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], kinds)
    others = F.flatten(F.transform("found", lambda f: F.transform(f["ids"], lambda i: F.struct(f["lost"].alias("lost"), i.alias("id")))))
    top = F.slice(F.array_sort(F.filter(others, lambda x: x["id"] != F.col("own"))), 1, k)
    each = own.join(asked.join(found, "query"), ["vec", "share"]).select("own", F.posexplode(top).alias("at", "x"))
    return each.select(F.col("own").alias("query_id"), (F.col("at") + 1).alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.lost")).alias("score"))

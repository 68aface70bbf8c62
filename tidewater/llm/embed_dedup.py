"""Near-duplicate embeddings by spherical-cap filters from random product codes.

A filter direction is one code word per block of the randomly rotated vector, so books of K words make K ** blocks directions
without being written out. Every vector is list-decoded to all directions whose inner product with it exceeds a threshold;
vectors that share a filter are candidates and are verified in double precision. Directions grow with the vectors, so that a
filter holds a fraction of a vector by chance. A rotation makes every vector look random to a code; threshold and number of
codes therefore follow from the dimension and the number of vectors alone, and plan() finds them by simulation: so many codes
that a pair exactly at the limit shares a filter with probability RECALL.

Equal vectors are one node. A filter offers edges between its centre and its other members, so a family of copies makes no pairs.
Members that are in different components still are compared next: as pairs in filters of few members, else in chunks whose
products are taken as matrices and yield one link for two components. Links are counted inside components, exactly: chunks of a
component are multiplied with each other, so a component of g vectors takes g * g / 2 products and moves g / (2 * CHUNK) times.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .components import components
from .shared import materialize
from .shingles import mix

#: Aimed at, per code.
FILTERS_PER_VECTOR = 8
VECTORS_PER_FILTER = 0.25
RECALL = 0.998
#: Words of a book, and components of a block, from which on vectors are cut into one block more.
WORDS, BLOCK = 16384, 4
#: Of pairs at the limit that share a filter of one code, at least.
SHARE = 0.2
#: Pairs of vectors that plan() simulates.
PAIRS = 192
#: Members of a chunk, and rows of it that are multiplied at a time.
CHUNK, STRIP = 4096, 512
#: Members of a filter whose pairs are written out.
FEW = 8
SEED = 5


class ProductCode:
    """words ** blocks filter directions for unit vectors of one length."""

    def __init__(self, number: int, dim: int, words: int, blocks: int):
        rng = np.random.default_rng([SEED, number, dim])
        self.turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0].astype(np.float32)
        self.cuts = np.array_split(np.arange(dim), blocks)
        self.books = []
        for cut in self.cuts:
            book = rng.standard_normal((words, len(cut)))
            book /= np.linalg.norm(book, axis=1, keepdims=True) * math.sqrt(blocks)
            self.books.append(book.T.astype(np.float32))

    def decode(self, v: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vector, direction, inner product) of all that exceed the threshold: block by block, branches are cut where even
        the best words of the blocks to come could not reach it."""
        v = v.astype(np.float32) @ self.turn
        scores = [v[:, cut] @ book for cut, book in zip(self.cuts, self.books)]
        best = np.array([s.max(1) for s in scores], np.float64)
        ahead = best.sum(0) - np.cumsum(best, axis=0)
        who, code, total = np.arange(len(v)), np.zeros(len(v), np.int64), np.zeros(len(v))
        for s, top, rest in zip(scores, best, ahead):
            of, word = np.nonzero(s >= (threshold - (best.sum(0) - top))[:, None])
            value = s[of, word].astype(np.float64)
            order = np.lexsort((-value, of))
            of, word, value = of[order], word[order], value[order]
            first = np.searchsorted(of, np.arange(len(v)))
            key = 4.0 * of - value  # grows along the list: vector by vector, best word first
            count = np.maximum(np.searchsorted(key, 4.0 * who - (threshold - total - rest[who]), side="right") - first[who], 0)
            at = np.repeat(first[who], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            who, code, total = np.repeat(who, count), np.repeat(code, count) * s.shape[1] + word[at], np.repeat(total, count) + value[at]
        return who, code, total


@functools.lru_cache(maxsize=64)
def plan(dim: int, count: int, least: float) -> tuple[int, int, float, int]:
    """(words, blocks, threshold, codes) for count vectors, from PAIRS simulated pairs of cosine least.

    Directions are taken coarser where caps would be so small that such pairs seldom share one: in few dimensions, where the
    links themselves are many.
    """
    rng = np.random.default_rng([SEED, dim])
    u = rng.standard_normal((PAIRS, dim))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.standard_normal((PAIRS, dim))
    w -= (w * u).sum(1, keepdims=True) * u
    norm = np.linalg.norm(w, axis=1, keepdims=True)
    v = least * u + math.sqrt(max(0.0, 1 - least * least)) * np.divide(w, norm, out=np.zeros_like(w), where=norm > 1e-9)
    wanted = max(64.0, count * FILTERS_PER_VECTOR / VECTORS_PER_FILTER)
    while True:
        blocks = 1
        if dim >= 2 * BLOCK:
            blocks = 2
            while wanted ** (1 / blocks) > WORDS and dim // (blocks + 1) >= BLOCK:
                blocks += 1
        words = math.ceil(min(wanted, WORDS) if blocks == 1 else wanted ** (1 / blocks))
        code = ProductCode(0, dim, words, blocks)
        aim = FILTERS_PER_VECTOR * PAIRS
        threshold = sum(float(np.mean(np.max(u.astype(np.float32) @ code.turn[:, cut] @ book, axis=1))) for cut, book in zip(code.cuts, code.books))
        while len(found := code.decode(u, threshold)[2]) < aim and threshold > 0:
            threshold = threshold * 0.97 - 1e-4
        threshold = float(np.sort(found)[-min(aim, len(found))])
        met = 0
        for number in range(1, 4):  # other codes than the one that set the threshold
            code = ProductCode(2**31 - number, dim, words, blocks)
            left, right = ({*zip(who.tolist(), direction.tolist())} for who, direction, _ in (code.decode(x, threshold) for x in (u, v)))
            met += len({pair for pair, _ in left & right})
        share = min(0.999, max(met, 1) / (3 * PAIRS))
        if share >= SHARE or wanted <= 64:
            return words, blocks, threshold, max(3, math.ceil(math.log(1 - RECALL) / math.log(1 - share)))
        wanted = max(64.0, wanted / 8)


@functools.lru_cache(maxsize=64)
def codes(dim: int, words: int, blocks: int, many: int) -> list[ProductCode]:
    return [ProductCode(k, dim, words, blocks) for k in range(many)]


def filters(v: np.ndarray, planned: tuple[int, int, float, int]) -> tuple[np.ndarray, np.ndarray]:
    """(vector, filter key) of unit vectors of one length, by what plan() gave for them."""
    words, blocks, threshold, many = planned
    own = codes(v.shape[1], words, blocks, many)
    who, keys = [], []
    for k, code in enumerate(own):
        i, direction, _ = code.decode(v, threshold)
        who.append(i)
        keys.append(mix(direction.astype(np.uint64) * np.uint64(2 * len(own) + 1) + np.uint64(k) ^ np.uint64(v.shape[1]) << np.uint64(48)).view(np.int64))
    return np.concatenate(who), np.concatenate(keys)


def _doubles(raws: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(raws), kind).astype(np.float64)


def _entries(nodes: DataFrame, plans: dict[int, tuple[int, int, float, int]], kind: str) -> DataFrame:
    """(filter, node) for every filter that a node's vector exceeds. plans: by length, made once, so that all tasks take the same
    filters whatever their processors round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                raws = part.column(1).to_pylist()
                sizes = np.fromiter(map(len, raws), np.int64, len(raws))
                for size in np.unique(sizes).tolist():
                    rows = np.flatnonzero(sizes == size)
                    v = _doubles([raws[i] for i in rows.tolist()], kind).reshape(len(rows), -1)
                    who, keys = filters(v / np.linalg.norm(v, axis=1, keepdims=True), plans[v.shape[1]])
                    yield pa.RecordBatch.from_arrays([pa.array(keys), part.column(0).take(pa.array(rows[who]))], names=["filter", "node"])

    return nodes.select("node", "vec").mapInArrow(run, f"filter bigint, node {nodes.schema['node'].dataType.simpleString()}")


def _verified(pairs: DataFrame, nodes: DataFrame, least: float, kind: str) -> DataFrame:
    """The pairs (a, b) of nodes of one length with a cosine of at least least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.zeros(0, bool)
            if batch.num_rows:
                left = batch.column(2).to_pylist()
                u, v = _doubles(left, kind), _doubles(batch.column(3).to_pylist(), kind)
                start = np.cumsum([0, *(len(x) for x in left[:-1])]) // np.dtype(kind).itemsize
                dot, uu, vv = (np.add.reduceat(x, start) for x in (u * v, u * u, v * v))
                near = dot >= least * np.sqrt(uu) * np.sqrt(vv)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(near)) for c in (batch.column(0), batch.column(1))], names=["a", "b"])

    of = pairs.schema["a"].dataType.simpleString()
    left, right = (nodes.select(F.col("node").alias(n), F.col("vec").alias(x)) for n, x in (("a", "u"), ("b", "v")))
    both = pairs.join(left, "a").join(right, "b").filter(F.octet_length("u") == F.octet_length("v")).select("a", "b", "u", "v")
    return both.mapInArrow(run, f"a {of}, b {of}")


def _vectors(rows: DataFrame, kind: str) -> DataFrame:
    """Rows (_x_id, _x_v) with vec, the components' bytes (doubles scaled by a power of two against overflow); null where the vector links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                x = np.array([np.nan if c is None else c for c in v or ()], dtype=np.float64)
                top = np.abs(x).max() if len(x) else 0.0
                usable = top > 0 and np.isfinite(top)
                if usable and kind == "<f8":
                    x = np.ldexp(x, -int(np.frexp(top)[1]))
                out.append((x + 0.0).astype(kind).tobytes() if usable else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["_x_id", "vec"])

    return rows.mapInArrow(run, f"_x_id {rows.schema['_x_id'].dataType.simpleString()}, vec binary")


def _products(held: DataFrame, group: str, tag: str, many, emit, schema: str, kind: str) -> DataFrame:
    """What emit gives for every two chunks of a group, and for each with itself. held: (group, node, tag, vec) with many chunks
    in their group; emit takes nodes and tags of both sides, a strip of rows and their inner products with norms."""
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    cells = materialize(
        held.withColumn("chunks", many).withColumn("chunk", chunk).groupBy(group, "chunks", "chunk").agg(F.collect_list(F.struct("node", tag, "vec")).alias("m")), "embed-chunks"
    )
    left = cells.select(group, "chunk", F.col("m").alias("u"), F.explode(F.sequence("chunk", F.col("chunks") - 1)).alias("other"))
    pairs = left.join(cells.select(group, F.col("chunk").alias("other"), F.col("m").alias("v")), [group, "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def own(members) -> tuple[list, list, np.ndarray, np.ndarray]:
            v = _doubles([m["vec"] for m in members], kind).reshape(len(members), -1)
            return [m["node"] for m in members], [m[tag] for m in members], v, np.sqrt((v * v).sum(1))

        for batch in batches:
            for k in range(batch.num_rows):
                same = batch.column(2)[k].as_py()
                left = own(batch.column(0)[k].as_py())
                right = left if same else own(batch.column(1)[k].as_py())
                yield from emit(left, right, same)

    return pairs.select("u", "v", (F.col("chunk") == F.col("other")).alias("same")).mapInArrow(run, schema)


def _strips(left: tuple, right: tuple, least: float, same: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, which pairs link) for strips of left's rows; no row links with itself."""
    for at in range(0, len(left[2]), STRIP):
        u, norm = left[2][at : at + STRIP], left[3][at : at + STRIP]
        near = u @ right[2].T >= least * norm[:, None] * right[3]
        if same:
            near[np.arange(len(u)), np.arange(at, at + len(u))] = False
        yield at, near


def _counted(named: DataFrame, sizes: DataFrame, least: float, kind: str) -> DataFrame:
    """(node, others): links of each node with copies of other nodes of its component, in parts to be summed."""
    of = to_arrow_type(named.schema["node"].dataType)

    def emit(left: tuple, right: tuple, same: bool) -> Iterator[pa.RecordBatch]:
        copies, back = np.array(right[1], np.int64), np.zeros(len(right[0]), np.int64)
        mine = np.array(left[1], np.int64)
        for at, near in _strips(left, right, least, same):
            yield pa.RecordBatch.from_arrays([pa.array(left[0][at : at + len(near)], type=of), pa.array(near @ copies)], names=["node", "others"])
            back += mine[at : at + len(near)] @ near
        if not same:
            yield pa.RecordBatch.from_arrays([pa.array(right[0], type=of), pa.array(back)], names=["node", "others"])

    held = named.select("component", "node", "copies", "vec").join(sizes, "component")
    return _products(held, "component", "copies", F.ceil(F.col("g") / CHUNK).cast("int"), emit, f"node {named.schema['node'].dataType.simpleString()}, others bigint", kind)


def _joining(crowded: DataFrame, least: float, kind: str) -> DataFrame:
    """Links (a, b) between nodes in different cells of a filter, from crowded (filter, size, node, cell, vec): of the links that two
    chunks have between the same two cells, one."""
    of = to_arrow_type(crowded.schema["node"].dataType)

    def emit(left: tuple, right: tuple, same: bool) -> Iterator[pa.RecordBatch]:
        _, cell = np.unique(np.array(left[1] + right[1]), return_inverse=True)
        mine, theirs = cell[: len(left[1])], cell[len(left[1]) :]
        for at, near in _strips(left, right, least, same):
            i, j = np.nonzero(near & (mine[at : at + len(near), None] != theirs))
            _, first = np.unique(mine[at + i] * len(cell) + theirs[j], return_index=True)
            a, b = [left[0][k] for k in (at + i[first]).tolist()], [right[0][k] for k in j[first].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(a, type=of), pa.array(b, type=of)], names=["a", "b"])

    kind_of = crowded.schema["node"].dataType.simpleString()
    return _products(crowded, "filter", "cell", F.ceil(F.col("size") / CHUNK).cast("int"), emit, f"a {kind_of}, b {kind_of}", kind)


def near_duplicate_vectors(df: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per input row: id, n_links, component_id, kept. Linked: cosine similarity of at least `least`.

    n_links counts the other rows linked directly, equal vectors included; component_id is the least id reachable, the
    row's own included; kept means both are equal. Defined cases: vectors that are null, empty, zero or hold null or
    non-finite components link with nothing; vectors of different lengths never link; a null id has a null component and
    kept = false; an empty table gives an empty result; other columns of df are ignored, whatever their names.
    """
    kind = "<f4" if df.schema[vector_col].dataType.elementType.simpleString() == "float" else "<f8"
    rows = materialize(_vectors(df.select(F.col(id_col).alias("_x_id"), F.col(vector_col).alias("_x_v")), kind), "embed-vectors")
    usable = rows.filter("vec is not null and _x_id is not null")
    nodes = materialize(usable.groupBy("vec").agg(F.min("_x_id").alias("node"), F.count(F.lit(1)).alias("copies")), "embed-nodes")
    lengths = nodes.groupBy((F.octet_length("vec") / np.dtype(kind).itemsize).cast("int").alias("dim")).count().collect()
    plans = {r["dim"]: plan(r["dim"], r["count"], least) for r in lengths}
    entries = materialize(_entries(nodes, plans, kind), "embed-entries")
    shared = entries.groupBy("filter").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = materialize(entries.join(shared, "filter"), "embed-members")
    scores = members.groupBy("node").agg(F.sum("size").alias("score"))
    centre = members.join(scores, "node").groupBy("filter").agg(F.max(F.struct("score", "node")).alias("c")).select("filter", F.col("c.node").alias("centre"))
    spokes = materialize(members.join(centre, "filter").filter("node != centre"), "embed-spokes")
    star = spokes.select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct()
    links = materialize(_verified(star, nodes, least, kind), "embed-links")

    # what is left: members other than the centre that are in different components
    labels = components(links)
    open_ = spokes.filter("size > 2").join(labels, "node", "left").select("filter", "size", "node", F.coalesce("component", "node").alias("cell"))
    cells = open_.select("filter", "cell").distinct()
    split = cells.groupBy("filter").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("filter")
    open_ = materialize(open_.join(split, "filter", "left_semi"), "embed-open")
    few = open_.filter(F.col("size") <= FEW)
    other = few.select("filter", F.col("node").alias("b"), F.col("cell").alias("cell_b"))
    pairs = few.select("filter", F.col("node").alias("a"), "cell").join(other, "filter").filter("a < b and cell != cell_b").select("a", "b").distinct()
    links = links.unionByName(materialize(_verified(pairs, nodes, least, kind), "embed-links"))
    crowded = open_.filter(F.col("size") > FEW).join(nodes.select("node", "vec"), "node")
    links = links.unionByName(materialize(_joining(crowded, least, kind), "embed-links"))
    labels = components(links)

    named = materialize(nodes.join(labels, "node"), "embed-named")
    sizes = materialize(named.groupBy("component").agg(F.count(F.lit(1)).alias("g")), "embed-sizes")
    degree = _counted(named, sizes, least, kind).groupBy("node").agg(F.sum("others").alias("others"))

    known = nodes.join(degree, "node", "left").join(labels, "node", "left").select("vec", "node", "copies", "others", "component")
    own = F.when(F.col("node").isNull(), F.col("_x_id")).otherwise(F.coalesce("component", "node"))
    component = F.when(F.col("_x_id").isNotNull(), own)
    return rows.join(known, "vec", "left").select(
        F.col("_x_id").alias(id_col),
        F.when(F.col("_x_id").isNull() | F.col("node").isNull(), F.lit(0)).otherwise(F.col("copies") - 1 + F.coalesce("others", F.lit(0))).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("_x_id") == component, F.lit(False)).alias("kept"),
    )

"""Merkle manifest of a dataset by time-forward processing.

Every group's leaves, in order, form a tree of fixed fan-out; the groups' tops, in order, form the tree above. A node's label is
its place in the order in which nodes can be computed: tier by tier, tree by tree, block by block, then level and index. Digests
travel forward in time through priority queues ordered by label: between tiers the queue is a sorted shuffle, which spills to
disk and is dealt over tasks by blocks of BLOCK consecutive nodes, complete subtrees of one height, so a source with a third of
all rows is as many blocks as it fills; inside a block it is a heap, whose messages are a child's digest under its parent's label.
A reversed sweep then goes down the labels: every node hands its children the siblings on their way to the root, and the leaves
get theirs whole. Tiers number the logarithm of the largest tree to the base BLOCK; every digest is computed from its children
once on the way up and once more, block by block, on the way down, instead of being stored for all leaves.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from .shared import materialize

FAN_OUT = 3
#: Levels, and nodes, of a block.
HEIGHT = 7
BLOCK = FAN_OUT**HEIGHT
#: Rows of a result's batch, about.
ROWS = 4096
#: A node's way to the root: left and right siblings at its level, then its parent's way; None at the root.
Way = tuple[bytes, bytes, "Way"] | None


def digest(data: bytes) -> bytes:
    """Lowercase hex SHA-256."""
    return hashlib.sha256(data).hexdigest().encode()


def forward(leaves: list[bytes], levels: int | None) -> bytes:
    """Top of one block: a heap delivers digests to parents in label order. levels: so many, or as many as leave one node."""
    sizes = [len(leaves)]
    while (sizes[-1] > 1) if levels is None else len(sizes) <= levels:
        sizes.append(-(-sizes[-1] // FAN_OUT))
    queue = [(1, k // FAN_OUT, k % FAN_OUT, leaf) for k, leaf in enumerate(leaves)] if len(sizes) > 1 else []
    top = leaves[0]
    while queue:
        level, index, _, own = heapq.heappop(queue)
        children = [own]
        while queue and queue[0][:2] == (level, index):
            children.append(heapq.heappop(queue)[3])
        top = digest(b"".join(children))
        if level + 1 < len(sizes):
            heapq.heappush(queue, (level + 1, index // FAN_OUT, index % FAN_OUT, top))
    return top


def reversed_sweep(leaves: list[bytes], levels: int | None, above: Way) -> list[Way]:
    """The leaves' ways to the root. above: the way of the block's top."""
    rows = [leaves]
    while (len(rows[-1]) > 1) if levels is None else len(rows) <= levels:
        rows.append([digest(b"".join(rows[-1][k : k + FAN_OUT])) for k in range(0, len(rows[-1]), FAN_OUT)])
    ways = [above]
    for row in reversed(rows[:-1]):
        runs = [row[k : k + FAN_OUT] for k in range(0, len(row), FAN_OUT)]
        ways = [(b"".join(run[:k]), b"".join(run[k + 1 :]), way) for run, way in zip(runs, ways) for k in range(len(run))]
    return ways


def siblings(way: Way) -> Iterator[tuple[bytes, bytes]]:
    while way is not None:
        left, right, way = way
        yield left, right


def fold(leaf: bytes, way: Way) -> bytes:
    """The root that a leaf and the siblings on its way give."""
    for left, right in siblings(way):
        leaf = digest(left + leaf + right)
    return leaf


def field(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; "-" for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[tuple]]]:
    """((tree, block), other values of its rows) of each run of rows of one block."""
    own, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:2] != own:
                if rows:
                    yield own, rows
                own, rows = row[:2], []
            rows.append(row[2:])
    if rows:
        yield own, rows


def _per_block(df: DataFrame, emit: Callable[[tuple[int, int], list[tuple]], Iterator[tuple]], columns: list[str], schema: str) -> DataFrame:
    """What emit gives for each block of df: its rows of the columns in order of idx."""
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for own, rows in _blocks(batches):
            found.extend(emit(own, rows))
            if len(found) >= ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

    dealt = df.withColumn("block", F.floor(F.col("idx") / BLOCK).cast("bigint")) if "block" not in df.columns else df
    return dealt.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx").select("tree", "block", *columns).mapInArrow(run, schema)


def indexed(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """df with tree (ascending with group, null first) and idx (place in its group by order, from 0).

    Rows are range-partitioned over group and order together, so a hot group is many partitions; places follow from the counts
    per partition and group.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    spread = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(spread.withColumn("_x_row", F.monotonically_increasing_id()).withColumn("_x_part", F.spark_partition_id()), "merkle-sorted")
    runs = placed.groupBy("_x_part", F.col(group).alias("_x_group")).agg(F.min("_x_row").alias("_x_first"), F.count(F.lit(1)).alias("_x_n"))
    runs = materialize(runs, "merkle-runs")
    # a row per partition and group; groups are numbered by partitions too, since these are in order
    before = F.sum("_x_n").over(Window.partitionBy("_x_group").orderBy("_x_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("_x_before", F.coalesce(before, F.lit(0))).withColumn("_x_new", (F.col("_x_before") == 0).cast("bigint"))
    within = Window.partitionBy("_x_part").orderBy("_x_first").rowsBetween(Window.unboundedPreceding, 0)
    runs = materialize(runs.withColumn("_x_nth", F.sum("_x_new").over(within)), "merkle-runs")
    parts = runs.groupBy("_x_part").agg(F.sum("_x_new").alias("_x_groups"))
    starts = parts.select(F.col("_x_part"), F.coalesce(F.sum("_x_groups").over(Window.orderBy("_x_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_x_start"))
    runs = materialize(runs.join(starts, "_x_part").select("_x_part", "_x_group", "_x_first", "_x_before", (F.col("_x_start") + F.col("_x_nth") - 1).alias("tree")), "merkle-runs")
    met = (placed["_x_part"] == runs["_x_part"]) & placed[group].eqNullSafe(runs["_x_group"])
    return placed.join(runs, met).select(*(placed[c] for c in df.columns), "tree", (F.col("_x_row") - F.col("_x_first") + F.col("_x_before")).alias("idx"))


def tops(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """((tree, tier, digest) with every tree's top, tiers of nodes) from nodes (tree, idx, digest). The nodes of a tier are the
    tops of the blocks of the tier below; a tree's top is that of the tier that holds it in one block."""

    def emit(own: tuple[int, int], rows: list[tuple]) -> Iterator[tuple]:
        leaves = [r[0] for r in rows]
        yield *own, forward(leaves, HEIGHT), forward(leaves, None) if own[1] == 0 else None

    tiers, found = [], []
    while not tiers or not nodes.isEmpty():
        tiers.append(nodes)
        blocks = materialize(_per_block(nodes, emit, ["digest"], "tree bigint, block bigint, digest binary, whole binary"), "merkle-tier")
        many = blocks.filter("block = 1").select("tree")
        found.append(blocks.join(many, "tree", "left_anti").select("tree", F.lit(len(found)).alias("tier"), F.col("whole").alias("digest")))
        nodes = materialize(blocks.join(many, "tree", "left_semi").select("tree", F.col("block").alias("idx"), "digest"), "merkle-tier")
    return materialize(reduce(DataFrame.unionByName, found), "merkle-tops"), tiers


def _sweep(nodes: DataFrame, ways: DataFrame, emit: Callable[..., Iterator[tuple]], others: list[str], schema: str) -> DataFrame:
    """What emit gives for (idx, digest, *others), its way and its tree's subroot, for every node. ways: (tree, block, alone,
    way, subroot) of the blocks' tops; they travel as each block's first row, so no node carries them through the shuffle."""
    told = ways.withColumn("idx", F.lit(-1).cast("bigint"))
    both = nodes.withColumn("block", F.floor(F.col("idx") / BLOCK).cast("bigint")).unionByName(told, allowMissingColumns=True)

    def one(own: tuple[int, int], rows: list[tuple]) -> Iterator[tuple]:
        (_, _, alone, given, subroot, *_), nodes = rows[0], rows[1:]
        above: Way = None
        for step in reversed(given):
            above = (step["l"], step["r"], above)
        for (idx, value, _, _, _, *rest), way in zip(nodes, reversed_sweep([r[1] for r in nodes], None if alone else HEIGHT, above)):
            yield from emit(own[0], idx, value, way, subroot, *rest)

    return _per_block(both, one, ["idx", "digest", "alone", "way", "subroot", *others], schema)


_WAYS = "tree bigint, block bigint, alone boolean, way array<struct<l:binary,r:binary>>, subroot binary"


def ways_down(tiers: list[DataFrame], found: DataFrame) -> DataFrame:
    """(tree, block, alone, way, subroot) of the lowest tier's blocks, from found (tree, tier, way, subroot) with the ways of all
    tops: from the highest tier down, every node hands its way to the block whose top it is."""

    def emit(tree: int, idx: int, _: bytes, way: Way, subroot: bytes) -> Iterator[tuple]:
        yield tree, idx, False, [{"l": left, "r": right} for left, right in siblings(way)], subroot

    above = None
    for k in reversed(range(len(tiers))):
        ways = found.filter(F.col("tier") == k).select("tree", F.lit(0).cast("bigint").alias("block"), F.lit(True).alias("alone"), "way", "subroot")
        ways = ways if above is None else ways.unionByName(above)
        if k:
            above = materialize(_sweep(tiers[k], ways, emit, [], _WAYS), "merkle-ways")
    return ways


def merkle_manifest(
    df: DataFrame, tampered: Column, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text", leaf_cols: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")
) -> DataFrame:
    """One row per input row: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the SHA-256 of its columns, each with its byte count. Leaves ascend by id in their group; every FAN_OUT
    consecutive nodes become one until the group's subroot is left, and the subroots, ascending by group, likewise become the
    root. proof_sha256 is the digest of all siblings on the way up. folded_root folds them over the leaf as it is found: with
    the line feeds of its text deleted where tampered holds. verified: folded_root equals root.
    Defined cases: null values are "-" and differ from empty ones; a null group comes first, null ids come first in their group,
    equal ids follow by leaf, and rows equal in all of them are leaves of their own; a null of tampered counts as false; a lone
    leaf is its subroot, and one group's subroot is the root; an empty table gives an empty result; other columns are ignored.
    """
    found = df.select(
        F.col(id_col).alias("_x_id"), F.col(group_col).alias("_x_group"), F.sha2(F.concat(*(field(F.col(c)) for c in leaf_cols)), 256).alias("leaf"),
        F.when(F.coalesce(tampered, F.lit(False)), F.sha2(F.concat(*(field(F.replace(F.col(c).cast("string"), F.lit("\n"), F.lit("")) if c == text_col else F.col(c)) for c in leaf_cols)), 256)).alias("met"),
    )
    # the place in the files tells rows that are equal in everything apart, so that they too spread over partitions
    leaves = materialize(found, "merkle-found").withColumn("_x_tie", F.monotonically_increasing_id())
    leaves = materialize(
        indexed(leaves, "_x_group", ["_x_id", "leaf", "_x_tie"]).select("tree", "idx", "_x_id", F.col("leaf").cast("binary").alias("digest"), F.col("met").cast("binary").alias("met")), "merkle-leaves"
    )
    subroots, tiers = tops(leaves.select("tree", "idx", "digest"))
    over, upper = tops(subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("idx"), "digest"))
    root = bytes(top.digest) if (top := over.first()) else b""

    def tell(_: int, idx: int, value: bytes, way: Way, __: bytes) -> Iterator[tuple]:
        yield idx, [{"l": left, "r": right} for left, right in siblings(way)], value

    own = over.select("tree", "tier", F.array().cast("array<struct<l:binary,r:binary>>").alias("way"), F.lit(None).cast("binary").alias("subroot"))
    told = materialize(_sweep(upper[0], ways_down(upper, own), tell, [], "tree bigint, way array<struct<l:binary,r:binary>>, subroot binary"), "merkle-ways")
    ways = ways_down([leaves, *tiers[1:]], subroots.select("tree", "tier").join(told, "tree"))

    def prove(_: int, __: int, leaf: bytes, way: Way, subroot: bytes, own_id, met: bytes | None) -> Iterator[tuple]:
        proof = digest(b"".join(x for step in siblings(way) for x in step))
        folded = fold(leaf if met is None else met, way)
        yield own_id, leaf.decode(), subroot.decode(), root.decode(), proof.decode(), folded.decode(), folded == root

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"_x_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _sweep(leaves, ways, prove, ["_x_id", "met"], schema).withColumnRenamed("_x_id", id_col)

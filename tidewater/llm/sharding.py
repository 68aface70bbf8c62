"""Shards by extendible hashing: a directory over hash-prefix bits in which only oversized buckets split further.

The directory is built from byte sums of small hash cells, never from the documents themselves: sums go up the prefix tree
STRIDE bits at a time, and a shard is a prefix that fits while its parent does not. Cells that do not fit at the current
width go on with more bits. Once the key's 60 bits are used, rows that share a key are told apart by a row hash. Sums,
directory and documents meet in sorted joins, since all of them grow with the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize

HASH_BITS = 60
#: Levels of the prefix tree that one aggregation sums.
STRIDE = 4


def _hash60(text):
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _prefix(h, bits: int):
    return F.shiftright(h, HASH_BITS - bits)


def _bits_text(value, width):
    """The last `width` bits of value as text."""
    return F.when(width == 0, F.lit("")).otherwise(F.substring(F.lpad(F.bin(value), HASH_BITS, "0"), HASH_BITS + 1 - width, HASH_BITS))


def _split(rows: DataFrame, limit: int, last: bool, tag: str) -> tuple[DataFrame, DataFrame | None]:
    """(rows with a shard, rows that no prefix of 60 bits could separate). rows: _x_h, _x_bytes, _x_path and others."""
    total = rows.agg(F.sum("_x_bytes")).first()[0] or 0
    start, end = 0, min(HASH_BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + 3)
    done: list[DataFrame] = []
    pending = rows
    while True:
        cells = materialize(
            pending.groupBy("_x_path", _prefix(F.col("_x_h"), end).alias("_x_cell")).agg(
                F.sum("_x_bytes").alias("_x_bytes"), F.count(F.lit(1)).alias("_x_rows")
            ),
            f"shard-cells-{tag}",
        )
        sums = cells.select("_x_path", F.lit(end).alias("_x_depth"), F.col("_x_cell").alias("_x_prefix"), F.col("_x_bytes").alias("shard_bytes"), F.col("_x_rows").alias("shard_rows"))
        top = sums
        for high in range(end, start, -STRIDE):
            low = max(start, high - STRIDE)
            spread = top.withColumn("_x_up", F.explode(F.sequence(F.lit(1), F.lit(high - low))))
            up = spread.select("_x_path", (high - F.col("_x_up")).alias("_x_depth"), F.expr("shiftright(_x_prefix, _x_up)").alias("_x_prefix"), "shard_bytes", "shard_rows")
            up = up.groupBy("_x_path", "_x_depth", "_x_prefix").agg(F.sum("shard_bytes").alias("shard_bytes"), F.sum("shard_rows").alias("shard_rows"))
            up = materialize(up, f"shard-sums-{tag}")
            sums, top = sums.unionByName(up), up.filter(F.col("_x_depth") == low)
        fits = F.col("shard_bytes") <= limit
        if last and end == HASH_BITS:  # single rows above the limit stay alone
            fits = fits | (F.col("_x_depth") == HASH_BITS)
        full = sums.filter(~(F.col("shard_bytes") <= limit)).select("_x_path", (F.col("_x_depth") + 1).alias("_x_depth"), F.col("_x_prefix").alias("_x_parent"))
        leaves = (
            sums.filter(fits).withColumn("_x_parent", F.shiftright("_x_prefix", 1)).join(full.hint("merge"), ["_x_path", "_x_depth", "_x_parent"], "left_semi")
            .unionByName(sums.filter(fits & (F.col("_x_depth") == start)).withColumn("_x_parent", F.shiftright("_x_prefix", 1)))
            if end > start else sums.filter(fits)
        )
        width = F.expr(f"{end} - _x_depth")
        first, after = (F.call_function("shiftleft", c, width) for c in (F.col("_x_prefix"), F.col("_x_prefix") + 1))
        directory = materialize(
            leaves.withColumn("_x_leaf", F.struct("_x_depth", "_x_prefix", "shard_bytes", "shard_rows"))
            .select("_x_path", F.explode(F.sequence(first, after - 1)).alias("_x_cell"), "_x_leaf"),
            f"shard-directory-{tag}",
        )
        keyed = pending.withColumn("_x_cell", _prefix(F.col("_x_h"), end))
        done.append(
            keyed.join(directory.hint("merge"), ["_x_path", "_x_cell"]).select(
                *[c for c in pending.columns if c != "_x_path"],
                F.concat("_x_path", _bits_text(F.col("_x_leaf._x_prefix"), F.col("_x_leaf._x_depth"))).alias("shard_id"),
                F.col("_x_leaf._x_depth").alias("depth"), F.col("_x_leaf.shard_bytes").alias("shard_bytes"), F.col("_x_leaf.shard_rows").alias("shard_rows"),
            )
        )
        left = cells.join(directory.hint("merge"), ["_x_path", "_x_cell"], "left_anti")
        if left.isEmpty():
            rest = None
            break
        pending = keyed.join(left.select("_x_path", "_x_cell").hint("merge"), ["_x_path", "_x_cell"], "left_semi").drop("_x_cell").select(*rows.columns)
        if end == HASH_BITS:
            rest = pending
            break
        start, end = end + 1, min(HASH_BITS, end + 6)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out, rest


def _keyed(df: DataFrame, id_col: str, text_col: str, *carried) -> DataFrame:
    return df.select(
        F.col(id_col).alias("_x_id"),
        F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("bigint").alias("_x_bytes"),
        _hash60(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("_x_h"),
        F.lit("").alias("_x_path"), *carried,
    )


def _assigned(rows: DataFrame, limit_bytes: int) -> DataFrame:
    """rows of _keyed with their shards."""
    out, rest = _split(rows, limit_bytes, False, "key")
    if rest is not None:
        own = rest.withColumn("_x_path", F.concat(_bits_text(F.col("_x_h"), F.lit(HASH_BITS)), F.lit("+"))).withColumn(
            "_x_h", _hash60(F.concat_ws(":", "_x_id", F.monotonically_increasing_id()))
        )
        more, _ = _split(materialize(own, "shard-repeats"), limit_bytes, True, "row")
        out = out.unionByName(more.withColumn("depth", F.col("depth") + HASH_BITS))
    return out


def extendible_shards(df: DataFrame, limit_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, shard_id (hash-prefix bits), depth, shard_bytes, shard_rows, oversized.

    Shards hold at most limit_bytes of UTF-8 text. Defined cases: a null text has 0 bytes; a null id hashes as the empty
    string; rows that repeat an id are split by a row hash after the key's bits ("bits+bits"); one document above
    the limit cannot be cut, it gets a shard alone and oversized = true; an empty table gives an empty result.
    """
    return _assigned(_keyed(df, id_col, text_col), limit_bytes).select(
        F.col("_x_id").alias(id_col), F.col("_x_bytes").alias("n_bytes"), "shard_id", F.col("depth").cast("int").alias("depth"),
        "shard_bytes", "shard_rows", (F.col("shard_bytes") > limit_bytes).alias("oversized"),
    )


def write_shards(df: DataFrame, path: str, limit_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write df under path, one folder per shard, every row once, repeated ids too; a shard's rows meet in one task, at most
    limit_bytes of text. The folders' column is shard, with underscores behind it where df has such a column."""
    name = "shard"
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_x_all")
    rows = _assigned(_keyed(df, id_col, text_col, whole), limit_bytes).select("_x_all.*", F.concat(F.lit("s"), "shard_id").alias(name))
    rows.repartition(name).write.partitionBy(name).parquet(path)

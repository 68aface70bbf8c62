"""Exact duplicate removal whose work stays even when one text holds a third of all rows.

Three combining stages, all on (digest, full text), so equal digests alone never merge two rows:
1. each input partition reduces its own copies (partial aggregation),
2. rows are merged per (digest, salt), the salt coming from the input partition,
3. the few salt winners of a text are combined globally.
The text is shuffled at most once per stage and a hot text contributes one row per input partition. drop_exact_copies takes
its rows from the third stage; exact_dedup, which reports every row, matches rows with their groups by digest: groups of at
least HOT_SHARE of all rows are few and broadcast, so no task gets more than that share of one text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import materialize

#: Groups with at least this share of all rows: at most 1 / HOT_SHARE of them exist.
HOT_SHARE = 1 / 1000


def _keyed(df: DataFrame, text_col: str, normalize) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = df.withColumn("_x_text", normalize(text) if normalize else text)
    return df.withColumn("_x_digest", F.sha2(F.col("_x_text").cast("binary"), 256))


def _combined(base: DataFrame, salts: int, first: list, then: list) -> DataFrame:
    """The second and third stage: base by digest, salt and text, then by digest and text."""
    merged = base.withColumn("_x_salt", F.pmod(F.spark_partition_id(), F.lit(salts))).groupBy("_x_digest", "_x_salt", "_x_text").agg(*first)
    return merged.repartition("_x_digest").groupBy("_x_digest", "_x_text").agg(*then)


def text_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16, normalize=None) -> DataFrame:
    """One row per distinct text: _x_digest, _x_text, keep_id, group_size."""
    base = _keyed(df.select(F.col(id_col).alias("_x_id"), text_col), text_col, normalize)
    first = [F.max("_x_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    return _combined(base, salts, first, [F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")])


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16, normalize=None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays. Defined cases: a null text counts as empty; a null id is smaller
    than any other, its row is kept only in a group without other ids; repeated rows (same id and text) get the same
    decision; an empty table gives an empty result; other columns of df are ignored, whatever their names.
    """
    df = df.select(F.col(id_col).alias("_x_id"), F.col(text_col).alias("_x_src"))
    winners = text_groups(df, "_x_id", "_x_src", salts, normalize)
    # one row per digest; the winners are already partitioned by digest, so this needs no further exchange
    by_digest = winners.groupBy("_x_digest").agg(
        F.count(F.lit(1)).alias("_x_texts"), F.max("keep_id").alias("_x_keep"), F.max("group_size").alias("_x_size"), F.sum("group_size").alias("_x_rows")
    )
    groups = materialize(by_digest.filter("_x_texts > 1 or _x_size > 1"), "exact-groups")
    rows = _keyed(df, "_x_src", normalize).drop("_x_src")
    ambiguous = groups.filter("_x_texts > 1").select("_x_digest")
    if ambiguous.isEmpty():
        out = _matched(rows.drop("_x_text"), groups)
    else:  # distinct texts under one digest: these rows are matched on their full content
        own = winners.join(ambiguous, "_x_digest", "left_semi").select("_x_digest", "_x_text", F.col("keep_id").alias("_x_keep"), F.col("group_size").alias("_x_size"))
        clear = _matched(rows.join(ambiguous, "_x_digest", "left_anti").drop("_x_text"), groups.filter("_x_texts = 1"))
        out = clear.unionByName(rows.join(own, ["_x_digest", "_x_text"], "inner").drop("_x_text"))
    keep = F.when(F.col("_x_size").isNull(), F.col("_x_id")).otherwise(F.col("_x_keep"))
    return out.select(
        F.col("_x_id").alias(id_col), keep.alias("keep_id"), F.coalesce("_x_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("_x_id").eqNullSafe(keep).alias("kept"), F.col("_x_digest").alias("text_sha256"),
    )


def _matched(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """rows (_x_id, _x_digest) with _x_keep and _x_size of their groups, null for a row alone."""
    groups = groups.select("_x_digest", "_x_keep", "_x_size", "_x_rows")
    total = groups.agg(F.sum("_x_rows")).first()[0] or 0
    hot = F.col("_x_rows") >= max(2.0, HOT_SHARE * total)
    few = groups.filter(hot).select("_x_digest", F.col("_x_keep").alias("_x_k"), F.col("_x_size").alias("_x_s")) if total * HOT_SHARE >= 2 else groups.limit(0).select("_x_digest", F.col("_x_keep").alias("_x_k"), F.col("_x_size").alias("_x_s"))
    rest = groups.filter(~hot) if total * HOT_SHARE >= 2 else groups
    found = rows.join(F.broadcast(few), "_x_digest", "left")  # at most 1 / HOT_SHARE rows
    # rows that have found their group meet nothing in the second join, and are spread over its tasks
    key = F.when(F.col("_x_s").isNull(), F.col("_x_digest")).otherwise(F.hex(F.xxhash64("_x_id")))
    found = found.withColumn("_x_key", key).join(rest.select(F.col("_x_digest").alias("_x_key"), "_x_keep", "_x_size"), "_x_key", "left")
    return found.select("_x_id", "_x_digest", F.coalesce("_x_k", "_x_keep").alias("_x_keep"), F.coalesce("_x_s", "_x_size").alias("_x_size"))


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16, normalize=None) -> DataFrame:
    """The rows of df that stay, with df's columns: of equal texts the one with the largest id, a null id being the smallest.

    Of rows that repeat the id too, the one with the greatest other columns stays. Null and empty texts are equal; the row
    that stays keeps its own. An empty table gives an empty result.
    """
    as_key = normalize is None and isinstance(df.schema[text_col].dataType, T.StringType)
    held = [c for c in df.columns if not (as_key and c == text_col)]
    row = F.struct(F.col(f"`{text_col}`").isNotNull().alias("_x_given"), *[F.col(f"`{c}`") for c in held])
    sortable = [F.col(f"`{c}`") for c in held if not _has_map(df.schema[c].dataType)]
    base = _keyed(df.select(row.alias("_x_row"), F.struct(F.col(f"`{id_col}`"), *sortable).alias("_x_order"), F.col(f"`{text_col}`").alias("_x_src")), "_x_src", normalize).drop("_x_src")
    first = [F.max("_x_order").alias("_x_top"), F.max_by("_x_row", "_x_order").alias("_x_row")]
    kept = _combined(base, salts, first, [F.max_by("_x_row", "_x_top").alias("_x_row")])
    text = F.when(F.col("_x_row._x_given"), F.col("_x_text"))
    return kept.select(*[text.alias(c) if as_key and c == text_col else F.col(f"_x_row.`{c}`").alias(c) for c in df.columns])


def _has_map(kind: T.DataType) -> bool:
    return any(word in kind.simpleString() for word in ("map<", "variant"))

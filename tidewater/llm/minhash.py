"""Near duplicates by one-permutation hashing, banded buckets and star-shaped candidate edges.

Documents with equal shingle sets are one node. Every node's sketch is cut into bands; nodes that share a band meet in a
bucket. A bucket offers only edges between its centre and its other members, so pairs grow with the members; the centre is
the member that meets the most others over all its buckets, which in a family of copies is the common origin. Each
candidate is confirmed on the full shingle sets. Then the members of each centre that are in different components still are
decided exactly: a link must share enough of what its ends differ from their centre, and only members and pairs for which
the counts of such parts leave that open become candidates (see _remainder), so no pair of a bucket is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import by_characters, materialize
from .shingles import OnePermutation, shingle_set

BANDS, ROWS = 40, 6
#: Of texts that a task holds as Python values at a time, or one text.
BATCH_CHARS = 8_000_000
#: Of counts that are alike for a bound, by centre.
LEVELS = 32


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _sketches(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """docs (_x_id, _x_text) as _x_id, n_shingles, _x_s1 and _x_s2 (digest of the full set), _x_bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = OnePermutation(bands, rows)
        for batch in by_characters(batches, 1, BATCH_CHARS):
            sets = [shingle_set(t, width) for t in batch.column(1).to_pylist()]
            digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
            halves = np.array([[d >> 64, d & (2**64 - 1)] for d in digests], dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), _lists([sketch.band_keys(s) for s in sets])],
                names=["_x_id", "n_shingles", "_x_s1", "_x_s2", "_x_bands"],
            )

    kind = docs.schema["_x_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"_x_id {kind}, n_shingles bigint, _x_s1 bigint, _x_s2 bigint, _x_bands array<bigint>")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_characters(batches, 1, BATCH_CHARS):
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists([shingle_set(t, width) for t in batch.column(1).to_pylist()])], names=["node", "set"])

    return docs.mapInArrow(run, f"node {docs.schema['_x_id'].dataType.simpleString()}, set array<bigint>")


def _confirm(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges (a, b) whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("_sa"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("_sb"))
    both = F.size(F.array_intersect("_sa", "_sb"))
    near = F.least(F.size("_sa"), F.size("_sb")) * 100 >= F.greatest(F.size("_sa"), F.size("_sb")) * percent
    return (
        edges.join(right, "b").join(left, "a").filter(near).withColumn("_i", both)
        .filter(F.col("_i") * 100 >= (F.size("_sa") + F.size("_sb") - F.col("_i")) * percent).select("a", "b").distinct()
    )


def _remainder(group: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b) among the members of each centre that are in different components: every link is among them.

    group: centre, centre_size, node, sized, component, far (not connected to the centre). D is the symmetric difference of
    a member and its centre. Sets x and y link exactly when 2 * (100 + percent) * |Dx & Dy| >= E(x) + E(y), where
    E = (100 + percent) * |D| - (100 - percent) * size. Only tokens that occur in several D of a centre can be in Dx & Dy;
    with r of them taken from the centre and x added to it, |Dx & Dy| <= min(rx, ry) + min(xx, xy). A member for which no
    other of its centre satisfies this bound is out; the others meet on the first tokens, rarest first, from whose place on
    there are enough in both. As a far member does not link with the centre, its E exceeds (100 - percent) * centre_size.
    """
    plus, minus = 100 + percent, 100 - percent
    diffs = materialize(
        group.join(sets.select("node", F.col("set").alias("_sb")), "node").join(sets.select(F.col("node").alias("centre"), F.col("set").alias("_sa")), "centre")
        .select("centre", "centre_size", "node", "sized", "component", "far", F.array_except("_sa", "_sb").alias("gone"), F.array_except("_sb", "_sa").alias("more"))
        .withColumn("e", plus * (F.size("gone") + F.size("more")) - minus * F.col("sized")),
        "minhash-differences",
    )
    tokens = diffs.select("centre", "node", F.explode("gone").alias("token"), F.lit(0).alias("added")).union(diffs.select("centre", "node", F.explode("more").alias("token"), F.lit(1).alias("added")))
    often = tokens.groupBy("centre", "token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ranked = (
        tokens.join(often, ["centre", "token"]).groupBy("centre", "node")
        .agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("tokens"), F.sum("added").alias("x"), F.sum(1 - F.col("added")).alias("r"))
    )
    known = materialize(diffs.drop("gone", "more").join(ranked, ["centre", "node"]), "minhash-ranked")

    def profiles(rows: DataFrame, name: str) -> DataFrame:
        """By centre, what its members can reach at best: at most LEVELS squared cells of members alike."""
        cell = [F.least(F.floor(F.col(c) * LEVELS / F.col("centre_size")), F.lit(LEVELS - 1)) for c in ("r", "x")]
        cells = rows.groupBy("centre", *cell).agg(F.max("r").alias("r"), F.max("x").alias("x"), F.min("e").alias("e"))
        return cells.groupBy("centre").agg(F.collect_list(F.struct("r", "x", "e")).alias(name))

    def may_link(with_: str):
        return F.exists(with_, lambda p: 2 * plus * (F.least("r", p["r"]) + F.least("x", p["x"])) >= F.col("e") + p["e"])

    far = known.filter("far")
    known = known.join(profiles(known, "_all"), "centre").join(profiles(far, "_far"), "centre").filter(F.when(F.col("far"), may_link("_all")).otherwise(may_link("_far"))).drop("_all", "_far")
    placed = known.select(*[c for c in known.columns if c != "tokens"], F.size("tokens").alias("_size"), F.posexplode("tokens").alias("_at", "_r"))
    placed = placed.withColumn("reach", 2 * plus * (F.col("_size") - F.col("_at"))).withColumn("short", F.col("reach") >= F.col("e") + minus * F.col("centre_size"))
    least = F.col("e") + 2 * percent - minus * F.col("centre_size")  # the partner is linked with the centre and differs from it
    placed = placed.filter(F.col("short") | (F.col("far") & (F.col("reach") >= least)))
    placed = materialize(placed.select("centre", F.col("_r.token").alias("token"), "node", "sized", "component", "far", "e", "r", "x", "reach", "short"), "minhash-prefixes")

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.select("centre", "token", *[F.col(c).alias("_" + c) for c in ("node", "sized", "component", "e", "r", "x", "reach")])
        fit = F.least("sized", "_sized") * 100 >= F.greatest("sized", "_sized") * percent
        enough = F.least(F.col("reach"), F.col("_reach"), 2 * plus * (F.least("r", "_r") + F.least("x", "_x"))) >= F.col("e") + F.col("_e")
        return left.join(right, ["centre", "token"]).filter((F.col("component") != F.col("_component")) & fit & enough).select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b"))

    far = placed.filter("far")
    between = meet(far.filter("short"), far.filter("short")).union(meet(placed.filter("not far"), far))
    return between.distinct()


def drop_near_copies(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df that stay: of every group of near copies the one with the least id, and all rows that link with nothing."""
    gone = near_duplicates(df, width, percent, id_col, text_col).filter(F.col("component_id") < F.col(id_col)).select(F.col(id_col).alias("_x_gone"))
    return df.join(gone, F.col(id_col) == F.col("_x_gone"), "left_anti")


def near_duplicates(
    df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept. Linked: Jaccard similarity of word shingles >= percent / 100.

    component_id is the least id reachable over links, the row's own id included; kept means both are equal. Defined
    cases: null or empty texts and texts without words have no shingle, link with nothing and stay; a null id has a null
    component and kept = false; rows that repeat an id are one node, which links with whatever one of its texts links with; an empty table gives an empty result; other columns
    of df are ignored, whatever their names.
    """
    docs = df.select(F.col(id_col).alias("_x_id"), F.col(text_col).cast("string").alias("_x_text"))
    sketches = materialize(_sketches(docs, width, bands, rows), "minhash-sketches")
    linkable = F.col("_x_id").isNotNull() & (F.col("n_shingles") > 0)
    digests = sketches.filter(linkable).groupBy("_x_s1", "_x_s2", "n_shingles").agg(F.min("_x_id").alias("node"))
    nodes = materialize(sketches.drop("_x_bands").join(digests, ["_x_s1", "_x_s2", "n_shingles"], "left"), "minhash-nodes")
    keys = (
        sketches.join(digests.select(F.col("node").alias("_x_id")).distinct(), "_x_id", "left_semi")
        .select(F.col("_x_id").alias("node"), F.col("n_shingles").alias("sized"), F.explode("_x_bands").alias("key")).distinct()
    )
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = materialize(keys.join(shared, "key"), "minhash-members")
    scores = members.groupBy("node").agg(F.sum("size").alias("score"))
    members = materialize(members.drop("size").join(scores, "node"), "minhash-members")
    involved = scores.select(F.col("node").alias("_x_id"))
    sets = materialize(_sets(docs.join(involved, "_x_id", "left_semi"), width), "minhash-sets")

    hub = members.groupBy("key").agg(F.max(F.struct("score", "node", "sized")).alias("_c")).select("key", F.col("_c.node").alias("centre"), F.col("_c.sized").alias("centre_size"))
    spokes = materialize(members.join(hub, "key").filter("node != centre").select("centre", "centre_size", "node", "sized").distinct(), "minhash-spokes")
    # sets whose sizes differ too much cannot be similar
    fit = F.least("sized", "centre_size") * 100 >= F.greatest("sized", "centre_size") * percent
    links = materialize(_confirm(spokes.filter(fit).select(F.col("centre").alias("a"), F.col("node").alias("b")), sets, percent), "minhash-links")
    labels = components(links)

    own, its = labels.select("node", F.col("component").alias("_own")), labels.select(F.col("node").alias("centre"), F.col("component").alias("_its"))
    named = spokes.join(own, "node", "left").join(its, "centre", "left").withColumn("component", F.coalesce("_own", "node"))
    named = materialize(named.withColumn("far", F.col("component") != F.coalesce("_its", "centre")).drop("_own", "_its"), "minhash-named")
    open_ = named.groupBy("centre").agg(F.min("component").alias("_l"), F.max("component").alias("_h")).filter("_l != _h").select("centre")
    rest = materialize(_remainder(named.join(open_, "centre", "left_semi"), sets, percent), "minhash-edges")
    more = materialize(_confirm(rest, sets, percent), "minhash-links")
    if not more.isEmpty():
        labels = components(links.union(more))
    named = nodes.join(labels, "node", "left")
    component = F.when(F.col("_x_id").isNotNull(), F.coalesce("component", "node", "_x_id"))
    return named.select(F.col("_x_id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("_x_id") == component, F.lit(False)).alias("kept"))

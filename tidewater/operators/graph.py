"""Discovery over a link graph: breadth-first search with filters, resume and failure sets, and link ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import checkpointed


def link_filter(links: DataFrame, known: DataFrame, handles: DataFrame, ignored: DataFrame, least_subs: int) -> DataFrame:
    """Links (channel, subs) worth following: not known, not a known handle, not ignored, of unknown or sufficient size."""
    out = links.filter(F.col("subs").isNull() | (F.col("subs") >= least_subs))
    for other in (known, handles, ignored):
        out = out.join(other.select(F.lower("channel").alias("_k")).distinct(), F.lower(F.col("channel")) == F.col("_k"), "left_anti")
    return out


def initial_queue(discovered: DataFrame, scraped: DataFrame, failed: DataFrame, known: DataFrame, seeds: DataFrame) -> DataFrame:
    """Channels to start from: seeds, and what a run before has found without scraping it."""
    orphans = discovered.select("channel")
    for other in (scraped, failed, known, seeds):
        orphans = orphans.join(other.select("channel").distinct(), "channel", "left_anti")
    return seeds.select("channel").unionByName(orphans).distinct()


def discover(edges: DataFrame, start: DataFrame, excluded: DataFrame, least_subs: int = 0, max_depth: int | None = None) -> DataFrame:
    """(channel, depth, subs): every channel reachable from start over edges (src, dst, subs) that pass the size filter; each at its
    least depth, start at 0, up to max_depth where one is given. Each round joins the frontier with the edges and takes away what
    was visited; edges and the tables between rounds are checkpointed."""
    usable = edges.filter(F.col("subs").isNull() | (F.col("subs") >= least_subs)).join(excluded.select(F.col("channel").alias("dst")).distinct(), "dst", "left_anti")
    best = checkpointed(usable.groupBy("src", "dst").agg(F.max("subs").alias("subs")))
    frontier = checkpointed(start.select("channel").distinct().select("channel", F.lit(0).alias("depth"), F.lit(None).cast("bigint").alias("subs")))
    visited, depth = frontier, 0
    while max_depth is None or depth < max_depth:
        depth += 1
        found = frontier.select(F.col("channel").alias("src")).join(best, "src").groupBy(F.col("dst").alias("channel")).agg(F.max("subs").alias("subs"))
        frontier = checkpointed(found.join(visited.select("channel"), "channel", "left_anti").select("channel", F.lit(depth).alias("depth"), F.col("subs").cast("bigint").alias("subs")))
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    return visited


def rank_links(edges: DataFrame) -> DataFrame:
    """(channel, in_degree, max_subs)."""
    return edges.groupBy(F.col("dst").alias("channel")).agg(F.countDistinct("src").alias("in_degree"), F.max("subs").alias("max_subs"))


def resolve_paths(links: DataFrame, creator_map: DataFrame) -> DataFrame:
    """links (channel, subs) with channel/UC... paths replaced by known handles."""
    cid = F.when(F.col("channel").startswith("channel/"), F.substring("channel", 9, 64))
    joined = links.withColumn("_id", cid).join(creator_map.select(F.col("channel_id").alias("_id"), "handle"), "_id", "left")
    return joined.select(F.coalesce("handle", "channel").alias("channel"), "subs").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node that is reachable, for every node of edges.

    Large stars and small stars in turn: every node links its greater neighbours to the least node that it sees, then its lesser
    ones, until each component is one star. Rounds grow with the logarithm of the longest chain, edges never grow in number,
    and a hub is a minimum that every task merges before it is shuffled. Edges are checkpointed after every half round.
    """
    plain = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    links = checkpointed(plain.filter("x != y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct())
    while True:
        both = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min(F.least("x", "y")).alias("m"))
        large = checkpointed(both.filter("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct())
        lower = large.groupBy("x").agg(F.min("y").alias("m"))
        others = large.join(lower, "x").filter("y != m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        small = checkpointed(others.unionByName(lower.select("x", F.col("m").alias("y"))).distinct())
        if small.exceptAll(links).isEmpty() and links.exceptAll(small).isEmpty():
            break
        links = small
    nodes = plain.select(F.col("x").alias("node")).union(plain.select("y")).distinct()
    return nodes.join(links.select(F.col("x").alias("node"), F.col("y").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))

"""Exact dedup, chat formatting and sharding: edge cases and SQL on the test tables."""

import hashlib

import pytest
from compare import both, database
from conftest import SMALL
from pyspark.sql import functions as F

from tidewater.llm import chat, exact_dedup, queries, sharding

DOC = "doc_id long, text string, keep_id string, _x_texts int"  # extra columns with clashing names


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, name):
    ours, theirs = both(queries.QUERIES[name](spark, SMALL), database(SMALL), queries.SQL[name])
    assert ours == theirs


def test_exact_dedup_cases(spark):
    rows = [(1, "a", "k", 0), (5, "a", "k", 0), (3, "a", None, 1), (7, None, "x", 2), (2, "", "x", 2), (9, "b", "x", 2), (None, "b", "x", 2), (None, "c", "x", 2), (4, "long " * 5000, "x", 3), (4, "long " * 5000, "x", 3)]
    df = spark.createDataFrame(rows, DOC)
    got = {(r.doc_id, r.text_sha256): r for r in exact_dedup.exact_dedup(df).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert exact_dedup.exact_dedup(df).count() == len(rows)
    assert (got[1, sha("a")].keep_id, got[1, sha("a")].group_size, got[1, sha("a")].kept) == (5, 3, False)
    assert got[5, sha("a")].kept and got[7, sha("")].kept and not got[2, sha("")].kept
    assert got[9, sha("b")].kept and not got[None, sha("b")].kept and got[None, sha("c")].kept
    kept = exact_dedup.drop_exact_copies(df)
    assert kept.columns == df.columns and sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([(5, "a"), (7, None), (9, "b"), (0, "c"), (4, "long " * 5000)], key=lambda x: (x[0], x[1] or ""))
    assert exact_dedup.drop_exact_copies(df.limit(0)).count() == 0
    maps = df.selectExpr("doc_id", "text", "map('a', text) AS m", "1 AS _x_row")
    assert exact_dedup.drop_exact_copies(maps).count() == 5 and exact_dedup.drop_exact_copies(maps, normalize=F.upper).columns == maps.columns
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def test_hot_groups_are_matched_by_broadcast(spark):
    df = spark.range(6000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN concat('pair', id div 6) ELSE concat('own', id) END AS text")
    got = {(r.group_size, r.n, r.kept) for r in exact_dedup.exact_dedup(df).selectExpr("group_size", "kept").groupBy("group_size").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()}
    assert got == {(2000, 2000, 1), (2, 2000, 1000), (1, 2000, 2000)}
    assert exact_dedup.drop_exact_copies(df).count() == 3001


def test_texts_under_one_digest_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.lit("same"))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "doc_id long, text string")
    assert {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(df).collect()} == {(1, 3, 2), (3, 3, 2), (2, 2, 1), (4, 4, 1)}


def test_chat_round_trip(spark):
    hard = ["</s>", "[INST] x [/INST]", "<\\/s>", "<s>[INST] user\nhi [/INST]", "<", "[/INST", "", None, "\\n<\\\\s>", "a b 😀", "x" * 50000]
    rows = [(c, t, role, text, "z") for c in range(3) for t, (role, text) in enumerate([("sys\\n\ntem", hard[c]), *[(("user", "assistant")[k % 2], h) for k, h in enumerate(hard)], ("user", "last")])]
    rows += [(9, 0, "user", "only user", "z"), (None, None, None, "no id", "z"), (4, 1, "assistant", "b", "z"), (4, 1, "assistant", "b", "z"), (4, 1, "assistant", "a", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    examples = chat.chat_examples(df)
    got = {r.conv_id: r for r in chat.chat_digest(examples).collect()}
    assert len(got) == 6
    for c, r in got.items():
        own = sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        turns = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for e in examples.filter("target_turn is not null and conv_id = 0").collect():
        assert e.formatted[e.loss_start + e.loss_chars :] == "</s>"
    assert chat.chat_examples(df.limit(0)).count() == 0


def test_sharding_cases(spark):
    df = spark.createDataFrame([(i, "x" * (i % 50), "s") for i in range(2000)] + [(5000, "y" * 900, "s"), (None, None, "s")], "doc_id long, text string, shard_id string")
    got = sharding.extendible_shards(df, 600).collect()
    sizes = {}
    for r in got:
        sizes.setdefault(r.shard_id, []).append(r.n_bytes)
    assert len(got) == 2002
    for r in got:
        assert r.shard_bytes == sum(sizes[r.shard_id]) and r.shard_rows == len(sizes[r.shard_id]) and (r.shard_bytes <= 600 or (r.oversized and r.shard_rows == 1 and r.n_bytes == 900))
    leaves = sorted(s for s in sizes if "+" not in s)
    assert all(not b.startswith(a) for a, b in zip(leaves, leaves[1:]))
    same = spark.createDataFrame([(1, "z" * 100)] * 40, "doc_id long, text string")
    assert max(r.shard_bytes for r in sharding.extendible_shards(same, 600).collect()) <= 600
    assert sharding.extendible_shards(df.limit(0), 600).count() == 0


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, "x" * 40) for i in range(100)], "doc_id long, text string")
    sharding.write_shards(df, str(tmp_path / "s"), 600)
    back = spark.read.option("basePath", str(tmp_path / "s")).parquet(str(tmp_path / "s"))
    assert back.select("doc_id").distinct().count() == 100 and back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("b")).filter("b > 600").count() == 0


def test_write_shards_keeps_repeated_ids_and_clashing_columns(spark, tmp_path):
    rows = [(k % 40 if k % 3 else None, f"text {k}" * (k % 9), "own", k) for k in range(300)] + [(7, "x" * 900, "own", 1)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, Shard_ int")
    sharding.write_shards(df, f"{tmp_path}/out", 1000)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.select(df.columns).exceptAll(df).isEmpty() and back.count() == 305
    sizes = back.groupBy("shard__").agg(F.sum(F.octet_length("text")).alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    assert len(sizes) > 5 and all(r.n <= 1000 or r.rows == 1 for r in sizes)

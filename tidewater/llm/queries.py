"""The opN_ queries: each applies its operator to its whole table. SQL holds what DuckDB can express of them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, embed_dedup, exact_dedup, lm, merkle, minhash, packing, pieces, quality, sharding, toxicity, vector_codes
from .shared import in_split

SHARD_BYTES = 1 << 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scored(docs: DataFrame, held_out) -> DataFrame:
    return docs.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").filter(~in_split("doc_id", 5, 0))
    model = toxicity.train_toxicity(docs, labels)
    return _scored(toxicity.score_toxicity(docs, model), in_split("doc_id", 5, 0))


def op2_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), seed=20, rate=0.1)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").filter(~in_split("doc_id", 3, 1))
    model = quality.train_quality(docs, labels)
    return _scored(quality.score_quality(docs, model), in_split("doc_id", 3, 1))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.sql("SELECT -1L conv_id, col1 turn, col2 role, '</s>[INST] ok [/INST]' text FROM VALUES (0L, 'user'), (1L, 'assistant')")
    return chat.chat_digest(chat.chat_examples(rows.unionByName(planted)))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = in_split("doc_id", 10, 0)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score_texts(docs, ~held_out).withColumn("held_out", held_out)


def op10_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.extendible_shards(_table(spark, sf_dir, "documents"), SHARD_BYTES)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(_table(spark, sf_dir, "embeddings"))


def _vector_codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Plain assignment of every part to every entry, round by round."""

    def assigned(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (
            SELECT p.r, p.part, min(list_sum(list_transform(list_zip(p.z, b.z), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) * {entries} + b.entry) AS m
            FROM p JOIN b{k} b ON p.part = b.part GROUP BY p.r, p.part)"""

    def moved(k: int) -> str:
        return f"""s{k} AS (
            SELECT part, m % {entries} AS entry, w, CAST(sum(z[w]) AS BIGINT) AS s, count(*) AS n
            FROM (SELECT p.part, a.m, p.z, unnest(range(1, len(p.z) + 1)) AS w FROM a{k} a JOIN p ON a.r = p.r AND a.part = p.part) GROUP BY ALL),
        b{k + 1} AS MATERIALIZED (
            SELECT part, entry, coalesce(n.z, o.z) AS z FROM b{k} o LEFT JOIN (
                SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY w) AS z FROM s{k} GROUP BY part, entry) n USING (part, entry))"""

    steps = ", ".join(f"{assigned(k)}, {moved(k)}" for k in range(rounds))
    return f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
                list_transform(embedding, lambda x: CAST(floor(256.0 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
            FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS MATERIALIZED (
            SELECT r, part, z[part * (len(z) // {parts}) + 1 : (part + 1) * (len(z) // {parts})] AS z
            FROM v, (SELECT CAST(unnest(range(0, {parts})) AS BIGINT) AS part)),
        b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, z FROM p WHERE r <= {entries}),
        {steps}, {assigned(rounds)},
        c AS (SELECT r, string_agg(printf('%02x', m % {entries}), '' ORDER BY part) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
            (SELECT sha256(string_agg(x, ',' ORDER BY part, entry, w)) FROM (
                SELECT part, entry, unnest(range(1, len(z) + 1)) AS w, unnest(z) AS x FROM b{rounds})) AS codebooks_sha256
        FROM c JOIN v USING (r)"""


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_manifest(_table(spark, sf_dir, "documents"), in_split("doc_id", 2, 0))


def _merkle_sql() -> str:
    """All levels of all trees, every leaf's siblings by joins, and a fold over them."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    field = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(field.format(text if c == "text" else c) for c in fields) + ")"
    # crc32 of the decimal id: a list of bytes, each followed by eight marks for the eight shifts
    bits = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"
    climb = """SELECT CAST(max(lvl) + 1 AS BIGINT), tree, idx // 3, sha256(string_agg(d, '' ORDER BY idx))
            FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM {0}) WHERE c > 1 GROUP BY tree, idx // 3"""
    step = """SELECT l.r, {2} + n.lvl AS lvl, coalesce(string_agg(n.d, '' ORDER BY n.idx) FILTER (n.idx < l.{1} // CAST(pow(3, n.lvl) AS BIGINT)), '') AS a,
                coalesce(string_agg(n.d, '' ORDER BY n.idx) FILTER (n.idx > l.{1} // CAST(pow(3, n.lvl) AS BIGINT)), '') AS b
            FROM l JOIN {0} n ON n.tree = {3} AND n.idx // 3 = l.{1} // CAST(pow(3, n.lvl) AS BIGINT) // 3
            JOIN (SELECT tree, max(lvl) AS top FROM {0} GROUP BY tree) t ON t.tree = n.tree AND n.lvl < t.top GROUP BY l.r, n.lvl"""
    return f"""
        WITH RECURSIVE d AS MATERIALIZED (
            SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {leaf("text")} AS leaf,
                CASE WHEN {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS met FROM documents),
        l AS MATERIALIZED (
            SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS r, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM d),
        up AS (SELECT CAST(0 AS BIGINT) AS lvl, tree, idx, leaf AS d FROM l UNION ALL {climb.format("up")}),
        tops AS MATERIALIZED (SELECT tree, arg_max(d, lvl) AS d FROM up GROUP BY tree),
        over_ AS (SELECT CAST(0 AS BIGINT) AS lvl, 0 AS tree, tree AS idx, d FROM tops UNION ALL {climb.format("over_")}),
        steps AS MATERIALIZED (
            SELECT *, row_number() OVER (PARTITION BY r ORDER BY lvl) - 1 AS k
            FROM ({step.format("up", "idx", 0, "l.tree")} UNION ALL {step.format("over_", "tree", 1000, 0)})),
        folds AS (
            SELECT r, CAST(0 AS BIGINT) AS k, met AS d FROM l
            UNION ALL SELECT f.r, f.k + 1, sha256(s.a || f.d || s.b) FROM folds f JOIN steps s ON s.r = f.r AND s.k = f.k),
        root AS (SELECT arg_max(d, lvl) AS root FROM over_),
        p AS (SELECT r, sha256(string_agg(a || b, '' ORDER BY k)) AS proof FROM steps GROUP BY r)
        SELECT l.doc_id, l.leaf, tops.d AS subroot, root, coalesce(p.proof, sha256('')) AS proof_sha256, e.d AS folded_root, e.d = root AS verified
        FROM l JOIN tops USING (tree) LEFT JOIN p USING (r) JOIN (SELECT r, arg_max(d, k) AS d FROM folds GROUP BY r) e USING (r) CROSS JOIN root"""


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_embed_dedup": op2_embed_dedup,
    "op3_minhash": op3_minhash,
    "op4_pieces": op4_pieces,
    "op6_quality": op6_quality,
    "op8_packing": op8_packing,
    "op5_exact_dedup": op5_exact_dedup,
    "op7_chat_format": op7_chat_format,
    "op9_lm": op9_lm,
    "op10_extendible_shards": op10_extendible_shards,
    "op11_vector_codes": op11_vector_codes,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_merkle_manifest": op13_merkle_manifest,
}

SQL = {
    "op5_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t""",
    "op7_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
        f AS (
            SELECT *, regexp_replace(text, '([<\[])(\\*(?:/?s>|/?INST\]))', '\1\\\2', 'g') AS esc FROM c)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(length(esc) + CASE WHEN role = 'assistant' THEN 4 ELSE 10 + length(role) + 1 + 8 END) AS BIGINT) AS formatted_chars
        FROM f GROUP BY conv_id""",
    "op10_extendible_shards": f"""
        WITH d AS (
            SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
                CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
        p AS (SELECT d.*, k.depth, h >> (60 - k.depth) AS prefix FROM d, (SELECT CAST(unnest(range(0, 30)) AS INTEGER) AS depth) k),
        s AS (SELECT depth, prefix, sum(n_bytes) AS shard_bytes, count(*) AS shard_rows FROM p GROUP BY depth, prefix),
        l AS (
            SELECT p.doc_id, p.n_bytes, p.depth, p.prefix, s.shard_bytes, s.shard_rows,
                row_number() OVER (PARTITION BY p.doc_id ORDER BY p.depth) AS k
            FROM p JOIN s ON p.depth = s.depth AND p.prefix = s.prefix WHERE s.shard_bytes <= {SHARD_BYTES})
        SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(prefix), 60, '0'), depth) END AS shard_id, depth,
            CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_rows, FALSE AS oversized
        FROM l WHERE k = 1""",
    "op11_vector_codes": _vector_codes_sql(),
    "op13_merkle_manifest": _merkle_sql(),
}

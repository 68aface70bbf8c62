"""How the operators' input roles are bound to the test tables: SQL that Spark and DuckDB both run, over whole tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.lineage import shared_dir

_PAD = "lpad(CAST({k} AS STRING), 22, '0')"

INPUTS = {
    # list lines in many forms; several lines name one channel
    "lines": """SELECT c_custkey AS pos, CASE c_custkey % 14
        WHEN 0 THEN 'Chan' || CAST(c_custkey % 97 AS STRING) WHEN 1 THEN 'chan' || CAST(c_custkey % 97 AS STRING)
        WHEN 2 THEN '@Chan' || CAST(c_custkey % 97 AS STRING) WHEN 3 THEN 'https://www.youtube.com/@Chan' || CAST(c_custkey % 97 AS STRING) || '/videos'
        WHEN 4 THEN '{{"channel":"Chan' || CAST(c_custkey % 97 AS STRING) || '","subs":' || CAST(c_custkey AS STRING) || '}}'
        WHEN 5 THEN 'chan' || CAST(c_custkey % 97 AS STRING) || ',2026-04-01' WHEN 6 THEN 'UC' || lpad(CAST(c_custkey % 97 AS STRING), 22, '0')
        WHEN 7 THEN 'channel/UC' || lpad(CAST(c_custkey % 97 AS STRING), 22, '0') WHEN 8 THEN 'Display Name ' || CAST(c_custkey % 97 AS STRING)
        WHEN 9 THEN '# note ' || CAST(c_custkey % 97 AS STRING)
        WHEN 10 THEN 'https://m.youtube.com/channel/UC' || lpad(CAST(c_custkey % 97 AS STRING), 22, '0') || '?x=1'
        WHEN 11 THEN 'id' || CAST(c_custkey AS STRING) || chr(9) || '@Tab' || CAST(c_custkey % 97 AS STRING)
        WHEN 12 THEN 'https://example.org/' || CAST(c_custkey % 97 AS STRING) ELSE ' uc' || lpad(CAST(c_custkey % 97 AS STRING), 22, '0') END AS value
        FROM {customer}""",
    # id -> handle, with several versions of an id
    "creator_map": """SELECT s_suppkey AS seq, 'UC' || lpad(CAST(s_suppkey % 61 AS STRING), 22, '0') AS channel_id, 'Handle' || CAST(s_suppkey AS STRING) AS handle FROM {supplier}""",
    "name_map": """SELECT s_suppkey AS seq, 'Display Name ' || CAST(s_suppkey % 53 AS STRING) AS title, 'UC' || lpad(CAST(s_suppkey % 71 AS STRING), 22, '0') AS channel_id FROM {supplier}""",
    # asset versions: identifier, directory, prefix rank, time
    "assets": """SELECT CAST(l_orderkey AS STRING) AS ident, CASE WHEN l_returnflag = 'N' THEN 'base' ELSE 'uploaded' END AS dir,
        CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS prefix_rank, CASE WHEN l_linestatus = 'F' THEN 'video-dlp-' ELSE 'video-min-' END AS prefix,
        l_partkey % 100 + l_linenumber AS mtime, l_linenumber AS line FROM {lineitem}""",
    # channels as customers, subscribers from the account balance (null for some)
    "creators": """SELECT 'UC' || lpad(CAST(c_custkey AS STRING), 22, '0') AS creator_id, c_name AS name,
        CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(floor(c_acctbal * c_custkey) AS BIGINT) END AS subs, c_custkey AS k FROM {customer}""",
    "queue": """SELECT 'UC' || lpad(CAST(c_custkey AS STRING), 22, '0') AS creator_id, c_name AS name, CAST(c_nationkey % 4 + 1 AS INT) AS tier,
        CAST(c_custkey % 1000 AS DOUBLE) AS due_ts FROM {customer} WHERE c_custkey % 3 <> 0""",
    "claims": """SELECT 'UC' || lpad(CAST(c_custkey AS STRING), 22, '0') AS creator_id, c_mktsegment AS owner FROM {customer} WHERE c_custkey % 7 = 1""",
    "no_feeds": """SELECT 'UC' || lpad(CAST(c_custkey AS STRING), 22, '0') AS creator_id, 'https://example.org/' || CAST(c_custkey AS STRING) AS url, c_name AS name,
        CAST(c_custkey % 60 AS BIGINT) AS count FROM {customer} WHERE c_custkey % 5 = 2""",
    # channel facts that name videos (parts), in time order
    "channel_videos": """SELECT CAST(l_partkey AS STRING) AS video_id, 'UC' || lpad(CAST(s_suppkey AS STRING), 22, '0') AS channel_id,
        CASE WHEN s_suppkey % 9 = 0 THEN s_name || 'VEVO' ELSE s_name END AS channel_handle, s_suppkey % 11 = 0 AS verified,
        CAST(floor(s_acctbal) AS BIGINT) + l_linenumber AS subscriber_count, l_orderkey AS mtime, l_linenumber AS seq
        FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey""",
    "outcomes": """SELECT event_id, ts, user_id AS key, event_type, event_type <> 'error' AS ok, value FROM {events}""",
    "edges": """SELECT DISTINCT 's' || CAST(a.l_suppkey AS STRING) AS src, 's' || CAST(b.l_suppkey AS STRING) AS dst, CAST(floor(s_acctbal) AS BIGINT) AS subs
        FROM {lineitem} a JOIN {lineitem} b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber JOIN {supplier} ON s_suppkey = b.l_suppkey
        WHERE a.l_suppkey <> b.l_suppkey""",
    # third-party rows under other column names, all text
    "third_party": """SELECT CASE WHEN p_partkey % 13 = 0 THEN ' ' ELSE 'v' || CAST(p_partkey AS STRING) END AS "videoId", p_name AS video_title,
        CASE WHEN p_partkey % 5 = 0 THEN '1e3' WHEN p_partkey % 5 = 1 THEN '' ELSE CAST(p_retailprice AS STRING) END AS views, CAST(p_size AS STRING) AS likes,
        CASE WHEN p_partkey % 4 = 0 THEN 'a|b| |c' WHEN p_partkey % 4 = 1 THEN '[None]' ELSE p_brand || '|' || p_type END AS tags,
        CASE p_partkey % 3 WHEN 0 THEN 'Shorts' WHEN 1 THEN 'VIDEO' ELSE 'other' END AS kind, '2024-06-15T10:30:00Z' AS published_at, '@h' || CAST(p_partkey % 29 AS STRING) AS channel,
        p_type AS description, p_brand AS slug FROM {part}""",
}


def rows(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The rows of an input role, or of SQL text, over sf_dir's tables."""
    text = INPUTS.get(sql, sql)
    tables = sorted(set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", text)))
    return spark.sql(text.replace('AS "videoId"', "AS videoId"), **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables})


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for queries that write and read again."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cte(*names: str) -> str:
    """WITH clause that gives DuckDB the same input roles."""
    plain = {n: re.sub(r"(?<!\{)\{(\w+)\}(?!\})", r"\1", INPUTS[n]).replace("{{", "{").replace("}}", "}") for n in names}
    return "WITH " + ", ".join(f"{n} AS ({s})" for n, s in plain.items()) + " "


def nest(path: str, inner: str) -> str:
    """JSON text of inner at a dotted path; "[]" after a name puts what follows into an array of one."""
    for name in reversed(path.split(".")):
        inner = f'{{"{name.removesuffix("[]")}":[{inner}]}}' if name.endswith("[]") else f'{{"{name}":{inner}}}'
    return inner


def merged(*texts: str) -> str:
    """One JSON object with the members of all, whose names differ; an empty text adds nothing."""
    return "{" + ",".join(t[1:-1] for t in texts if t) + "}"


def concat_sql(template: str) -> str:
    """SQL that puts a template together; <<expression>> stands for the text of an SQL expression."""
    parts = re.split("<<(.*?)>>", template, flags=re.S)
    quote = lambda t: "'" + t.replace("'", "''") + "'"
    return "concat(" + ", ".join(f"CAST(({x}) AS STRING)" if k % 2 else quote(x) for k, x in enumerate(parts) if x) + ")"


def by_case(key: str, *templates: str) -> str:
    """A template that is another one by the value of key: 0, 1, ..."""
    return "<<CASE " + key + "".join(f" WHEN {k} THEN {concat_sql(t) if t else chr(39) * 2}" for k, t in enumerate(templates)) + " END>>"


def payloads(key: str, table: str, template: str, more: str = "") -> str:
    """Rows k, further columns and payload over a table, as text for rows()."""
    return f"SELECT {key} AS k{more}, {concat_sql(template)} AS payload FROM ".replace("{", "{{").replace("}", "}}") + "{" + table + "}"

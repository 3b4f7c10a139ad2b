"""Views of the driver's tables that stand for payloads, ledgers and runs.

Each view has one SQL text for both engines; the few dialect differences are
named placeholders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import bound_batches

_DIALECT = {
    "spark": {"EPOCH": "unix_micros(cast(ts as timestamp)) div 1000000", "DIV": "div", "SHA8": "substr(sha1(cast(text as binary)), 1, 8)", "BIG": "bigint"},
    "duckdb": {"EPOCH": "cast(floor(epoch(ts)) as bigint)", "DIV": "//", "SHA8": "substr(sha1(text), 1, 8)", "BIG": "bigint"},
}

_VIEWS = {
    "ledger": """
        SELECT event_id, {EPOCH} AS ts, event_type AS server,
          CASE WHEN event_id % 5 = 0 THEN concat(event_type, '__t', user_id % 8) ELSE concat('t', user_id % 8) END AS tool,
          CASE WHEN event_id % 17 = 0 THEN 'retrieve' WHEN event_id % 19 = 0 THEN 'primer' END AS event,
          CASE WHEN event_id % 13 <> 0 THEN concat('v', event_id % 3) END AS version,
          CASE event_id % 4 WHEN 0 THEN 'compressed' WHEN 1 THEN 'diff' WHEN 2 THEN 'unchanged' ELSE 'passthrough' END AS decision,
          CASE event_id % 6 WHEN 0 THEN 'emitted' WHEN 1 THEN 'no_prior' WHEN 2 THEN 'keyframe' END AS diff_reason,
          40 + event_id % 400 AS raw_chars, (40 + event_id % 400) * (event_id % 10) {DIV} 10 AS out_chars,
          CASE WHEN event_id % 11 <> 0 THEN (40 + event_id % 400) {DIV} 4 END AS raw_tokens,
          CASE WHEN event_id % 11 <> 0 THEN ((40 + event_id % 400) * (event_id % 10) {DIV} 10) {DIV} 4 END AS out_tokens,
          concat('$.', user_id % 4) AS path, event_id % 3 <> 0 AS hit, 40 + event_id % 400 AS bytes,
          CASE WHEN event_id % 11 <> 0 THEN (40 + event_id % 400) {DIV} 4 END AS tokens,
          CASE WHEN event_id % 2 = 0 THEN 'once/session' ELSE 'per-turn' END AS cadence,
          CASE WHEN event_id % 7 = 0 THEN false WHEN event_id % 5 = 0 THEN NULL ELSE true END AS attached
        FROM events""",
    "payloads": """
        SELECT lang AS tool, CASE WHEN doc_id % 6 <> 0 THEN source END AS server, text AS raw, {SHA8} AS sha,
          doc_id AS captured_at, doc_id
        FROM documents""",
    "turns": "SELECT conv_id, turn, role, text AS raw, {SHA8} AS sha FROM conversations",
    "eval_rows": """
        SELECT l_returnflag AS model, l_partkey AS question, count(*) AS trials,
          cast(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS {BIG}) AS form_ok,
          cast(sum(CASE WHEN l_quantity >= 10 THEN 1 ELSE 0 END) AS {BIG}) AS control_ok
        FROM lineitem GROUP BY l_returnflag, l_partkey""",
    "cells": """
        SELECT l_suppkey AS payload, 'l_linenumber' AS key, cast(l_linenumber AS string) AS value FROM lineitem
        UNION ALL SELECT l_suppkey, 'l_returnflag', l_returnflag FROM lineitem
        UNION ALL SELECT l_suppkey, 'l_linestatus', l_linestatus FROM lineitem
        UNION ALL SELECT l_suppkey, 'l_partkey', cast(l_partkey AS string) FROM lineitem""",
    "snap_prev": "SELECT o_orderkey AS k, o_orderstatus AS status, o_orderpriority AS priority FROM orders WHERE o_orderkey % 7 <> 0",
    "snap_curr": """
        SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN concat(o_orderstatus, '!') ELSE o_orderstatus END AS status,
          o_orderpriority AS priority
        FROM orders WHERE o_orderkey % 11 <> 0""",
    "entries": """
        SELECT s_suppkey AS entry, CASE WHEN s_suppkey % 6 <> 0 THEN s_suppkey % 5 * 100 END AS primer_tokens,
          CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey % 4 * 50 END AS blocks, s_suppkey % 3 * 40 AS tokenized,
          (s_suppkey % 9 - 3) * 700 AS saved, CASE WHEN s_suppkey % 2 = 0 THEN 'router' ELSE 'wrapped' END AS state,
          CASE WHEN s_suppkey % 8 <> 0 THEN s_suppkey % 3 END AS encoded
        FROM supplier""",
}


def view_sql(name: str, dialect: str) -> str:
    return _VIEWS[name].format(**_DIALECT[dialect])


def with_views(*names: str) -> str:
    """A WITH clause of the views, for DuckDB."""
    return "WITH " + ", ".join(f"{n} AS ({view_sql(n, 'duckdb')})" for n in names) + " "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view over the tables of ``sf_dir``; nothing is registered in the catalog."""
    tables = {}
    for t in ("events", "documents", "conversations", "lineitem", "orders", "supplier"):
        if f"FROM {t}" in _VIEWS[name]:
            tables[t] = table(spark, sf_dir, t)
    sql = view_sql(name, "spark")
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}")
    return spark.sql(sql, **tables)

"""Queries of the set-oriented operators over the driver's tables, each with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..operators import corpus, evaluation, ledger, policy, probes, sequence, snapshot
from ..sources.views import table, view, with_views

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    def keep(function):
        QUERIES[name] = function
        if sql:
            ctes = with_views(*views)
            body = sql.strip()
            if views and body[:5].upper() == "WITH ":
                body = ", " + body[5:]
                ctes = ctes.rstrip()
            ORACLE_SQL[name] = (ctes if views else "") + body
        return function

    return keep


_RESULT = "event IS NULL AND raw_chars IS NOT NULL AND out_chars IS NOT NULL"
_CANON = "CASE WHEN starts_with(tool, server || '__') AND length(tool) > length(server) + 2 THEN substr(tool, length(server) + 3) ELSE tool END"
_KNOWN = "raw_tokens IS NOT NULL AND out_tokens IS NOT NULL"
_SUMS = f"""CAST(coalesce(sum(CASE WHEN {_KNOWN} THEN raw_tokens END), 0) AS BIGINT) AS raw_tokens,
  CAST(coalesce(sum(CASE WHEN {_KNOWN} THEN out_tokens END), 0) AS BIGINT) AS out_tokens"""

# --- ledger -------------------------------------------------------------------


@query("ledger_by_tool", f"""
SELECT *, raw_tokens - out_tokens AS saved_tokens FROM (
  SELECT server, {_CANON} AS tool, count(*) AS blocks, count(*) FILTER (WHERE {_KNOWN}) AS tokenized,
    count(*) FILTER (WHERE decision NOT IN ('passthrough', 'unchanged')) AS encoded, count(*) FILTER (WHERE decision = 'diff') AS diffs,
    {_SUMS}, CAST(sum(raw_chars) AS BIGINT) AS raw_chars, CAST(sum(out_chars) AS BIGINT) AS out_chars
  FROM ledger WHERE {_RESULT} GROUP BY ALL)""", ("ledger",))  # fmt: skip
def ledger_by_tool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.by_tool(view(spark, sf_dir, "ledger")).orderBy(F.desc("saved_tokens"), "server", "tool")


@query("ledger_totals", f"""
SELECT count(*) AS blocks, CAST(sum(raw_chars) AS BIGINT) AS raw_chars, CAST(sum(out_chars) AS BIGINT) AS out_chars, {_SUMS},
  count(*) FILTER (WHERE NOT ({_KNOWN})) AS untokenized, count(*) FILTER (WHERE version IS NULL) AS unversioned
FROM ledger WHERE {_RESULT}""", ("ledger",))  # fmt: skip
def ledger_totals(spark, sf_dir):
    return ledger.totals(view(spark, sf_dir, "ledger"))


@query("ledger_decisions", f"SELECT decision, count(*) AS blocks FROM ledger WHERE {_RESULT} GROUP BY 1", ("ledger",))
def ledger_decisions(spark, sf_dir):
    return ledger.by_decision(view(spark, sf_dir, "ledger"))


@query("ledger_diff_reasons", f"SELECT diff_reason, count(*) AS blocks FROM ledger WHERE {_RESULT} AND diff_reason IS NOT NULL GROUP BY 1", ("ledger",))
def ledger_diff_reasons(spark, sf_dir):
    return ledger.by_diff_reason(view(spark, sf_dir, "ledger"))


@query("ledger_versions", f"""
SELECT version, count(*) AS blocks, count(*) FILTER (WHERE {_KNOWN}) AS tokenized, {_SUMS}
FROM ledger WHERE {_RESULT} AND version IS NOT NULL GROUP BY 1""", ("ledger",))  # fmt: skip
def ledger_versions(spark, sf_dir):
    return ledger.by_version(view(spark, sf_dir, "ledger"))


@query("ledger_retrieves", f"""
SELECT server, {_CANON} AS tool, path, count(*) AS calls, count(*) FILTER (WHERE hit) AS hits, count(*) FILTER (WHERE NOT hit) AS misses,
  CAST(sum(bytes) AS BIGINT) AS bytes, CAST(coalesce(sum(tokens), 0) AS BIGINT) AS tokens, count(*) FILTER (WHERE tokens IS NULL) AS untokenized
FROM ledger WHERE event = 'retrieve' GROUP BY ALL""", ("ledger",))  # fmt: skip
def ledger_retrieves(spark, sf_dir):
    return ledger.retrieves(view(spark, sf_dir, "ledger"))


@query("ledger_primers", """
SELECT server, cadence, coalesce(attached, true) AS attached, count(*) AS emissions, CAST(sum(bytes) AS BIGINT) AS bytes,
  CAST(coalesce(sum(tokens), 0) AS BIGINT) AS tokens, count(*) FILTER (WHERE tokens IS NULL) AS untokenized
FROM ledger WHERE event = 'primer' GROUP BY ALL""", ("ledger",))  # fmt: skip
def ledger_primers(spark, sf_dir):
    return ledger.primers(view(spark, sf_dir, "ledger"))


@query("ledger_window", f"""
SELECT count(*) AS blocks, {_SUMS} FROM ledger
WHERE {_RESULT} AND ts >= (SELECT max(ts) - 7 * 86400 FROM ledger)""", ("ledger",))  # fmt: skip
def ledger_window(spark, sf_dir):
    rows = view(spark, sf_dir, "ledger")
    start = rows.agg((F.max("ts") - P.window_seconds(F.lit("7d"))).alias("start"))
    recent = rows.join(F.broadcast(start), F.col("ts") >= F.col("start"))  # one row
    return ledger.totals(recent).select("blocks", "raw_tokens", "out_tokens")


@query("ledger_grouping_sets", f"""
SELECT server, CASE WHEN grouping(tool) = 0 THEN tool END AS tool, decision, count(*) AS blocks, {_SUMS}
FROM (SELECT server, {_CANON} AS tool, decision, raw_tokens, out_tokens FROM ledger WHERE {_RESULT})
GROUP BY GROUPING SETS ((), (server), (server, tool), (decision))""", ("ledger",))  # fmt: skip
def ledger_grouping_sets(spark, sf_dir):
    return ledger.everything(view(spark, sf_dir, "ledger")).drop("level")


@query("canonical_tool", f"SELECT DISTINCT server, tool, {_CANON} AS canonical FROM ledger", ("ledger",))
def canonical_tool(spark, sf_dir):
    rows = view(spark, sf_dir, "ledger").select("server", "tool").distinct()
    return rows.withColumn("canonical", P.canonical_tool(F.col("server"), F.col("tool")))


@query("classify_decision", """
SELECT decision, count(*) AS n FROM (
  SELECT CASE WHEN doc_id % 5 = 0 THEN 'passthrough' WHEN e = text THEN 'unchanged' WHEN contains(substr(e, 1, 40), '__diff__') THEN 'diff' ELSE 'compressed' END AS decision
  FROM (SELECT *, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN '{"__diff__":1' || text ELSE text || '__diff__' END AS e FROM documents)) GROUP BY 1""")  # fmt: skip
def classify_decision(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    emitted = F.when(F.col("doc_id") % 3 == 0, F.col("text")).when(F.col("doc_id") % 3 == 1, F.concat(F.lit('{"__diff__":1'), F.col("text"))).otherwise(F.concat(F.col("text"), F.lit("__diff__")))
    return docs.groupBy(P.classify_decision(F.col("text"), emitted, F.col("doc_id") % 5 != 0, "__diff__").alias("decision")).agg(F.count(F.lit(1)).alias("n"))


_BREAK_EVEN = """
SELECT entry, saved_per_block, blocks_to_break_even, v AS break_even_verdict, cadence, primer_tokens, tokenized FROM (
  SELECT *, CASE WHEN rated THEN saved / tokenized END AS saved_per_block,
    CASE WHEN rated AND primer_tokens = 0 THEN 0.0::DOUBLE WHEN rated AND saved > 0 THEN primer_tokens / (saved / tokenized) END AS blocks_to_break_even,
    CASE WHEN blocks IS NULL THEN 'no ledger label' WHEN blocks = 0 THEN 'never called' WHEN tokenized = 0 THEN 'no token data'
      WHEN primer_tokens IS NULL THEN 'primer unknown' WHEN primer_tokens = 0 THEN 'no primer' WHEN saved <= 0 THEN 'never' END AS v,
    CASE WHEN state = 'router' THEN 'per-turn' WHEN blocks IS NULL THEN 'once/session (?)' WHEN coalesce(encoded, blocks) <> 0 THEN 'once/session' ELSE 'once/session (unpaid)' END AS cadence
  FROM (SELECT *, blocks IS NOT NULL AND blocks <> 0 AND tokenized <> 0 AS rated FROM entries))"""


@query("break_even", _BREAK_EVEN, ("entries",))
def break_even(spark, sf_dir):
    rows = ledger.cadence(ledger.break_even(view(spark, sf_dir, "entries")))
    return rows.select("entry", "saved_per_block", "blocks_to_break_even", "break_even_verdict", "cadence", "primer_tokens", "tokenized")


@query("recommend", f"""
SELECT entry, CASE
    WHEN v IN ('no ledger label', 'no token data', 'primer unknown') THEN 'INSUFFICIENT'
    WHEN v = 'never called' THEN CASE WHEN cadence = 'per-turn' AND coalesce(primer_tokens, 0) <> 0 THEN 'UNWRAP' ELSE 'INSUFFICIENT' END
    WHEN v = 'never' THEN 'UNWRAP' WHEN v = 'no primer' THEN CASE WHEN saved_per_block < 0 THEN 'UNWRAP' ELSE 'KEEP' END
    WHEN tokenized >= blocks_to_break_even THEN 'KEEP' ELSE 'TUNE' END AS verdict,
  CASE WHEN v = 'no primer' AND saved_per_block < 0 THEN 'expanding' WHEN v IS NOT NULL THEN v
    WHEN tokenized >= blocks_to_break_even THEN 'cleared' ELSE 'short of break-even' END AS verdict_reason,
  CASE WHEN v = 'never' AND primer_tokens <> 0 THEN saved_per_block * tokenized / primer_tokens
    WHEN v IS NULL THEN tokenized / blocks_to_break_even END AS break_even_coverage
FROM (SELECT *, break_even_verdict AS v FROM ({_BREAK_EVEN}))""", ("entries",))  # fmt: skip
def recommend(spark, sf_dir):
    rows = ledger.recommend(ledger.cadence(ledger.break_even(view(spark, sf_dir, "entries"))))
    return rows.select("entry", "verdict", "verdict_reason", "break_even_coverage").orderBy(ledger.verdict_order(F.col("verdict")), "entry")


@query("contributors", f"""
SELECT server AS label, count(*) AS blocks, count(*) FILTER (WHERE {_KNOWN}) AS tokenized_blocks,
  CAST(sum(CASE WHEN {_KNOWN} THEN raw_tokens - out_tokens ELSE 0 END) AS BIGINT) AS saved_tokens,
  sum(CASE WHEN {_KNOWN} THEN raw_tokens - out_tokens ELSE 0 END) / count(*) FILTER (WHERE {_KNOWN}) AS saved_per_block
FROM ledger WHERE {_RESULT} GROUP BY 1""", ("ledger",))  # fmt: skip
def contributors(spark, sf_dir):
    return ledger.contributors(ledger.by_tool(view(spark, sf_dir, "ledger")))


@query("primer_liability", f"""
WITH t AS (SELECT server AS label, count(*) AS blocks, count(*) FILTER (WHERE {_KNOWN}) AS tokenized,
    sum(CASE WHEN {_KNOWN} THEN raw_tokens - out_tokens ELSE 0 END) AS saved FROM ledger WHERE {_RESULT} GROUP BY 1),
  p AS (SELECT server AS label, sum(CASE WHEN coalesce(attached, true) THEN tokens END) AS s,
    count(CASE WHEN coalesce(attached, true) THEN tokens END) AS n FROM ledger WHERE event = 'primer' GROUP BY 1)
SELECT t.label AS entry, CAST(t.blocks AS BIGINT) AS blocks, s / n AS primer_tokens, saved / tokenized AS saved_per_block,
  CASE WHEN saved > 0 THEN (s / n) / (saved / tokenized) END AS blocks_to_break_even,
  CASE WHEN saved <= 0 THEN 'UNWRAP' WHEN tokenized >= (s / n) / (saved / tokenized) THEN 'KEEP' ELSE 'TUNE' END AS verdict
FROM t JOIN p USING (label)""", ("ledger",))  # fmt: skip
def primer_liability(spark, sf_dir):
    rows = view(spark, sf_dir, "ledger")
    tools = ledger.by_tool(rows)
    labels = tools.select(F.col("server").alias("entry"), F.col("server").alias("label")).distinct()
    entries = labels.select("entry", F.lit("wrapped").alias("state"), F.lit(248).alias("primer_tokens"))
    return ledger.liability(entries, labels, tools, ledger.primers(rows)).select("entry", "blocks", "primer_tokens", "saved_per_block", "blocks_to_break_even", "verdict")


@query("blind_spots", f"""
WITH t AS (SELECT server, {_CANON} AS tool, count(*) AS blocks, {_SUMS} FROM ledger WHERE {_RESULT} GROUP BY ALL),
  c AS (SELECT DISTINCT CASE WHEN user_id % 3 <> 0 THEN event_type END AS server, 't' || (user_id % 4) AS tool FROM events WHERE value > 0)
SELECT server, tool, blocks, raw_tokens FROM t
WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.server = t.server AND c.tool = t.tool) AND NOT EXISTS (SELECT 1 FROM c WHERE c.server IS NULL AND c.tool = t.tool)""", ("ledger",))  # fmt: skip
def blind_spots(spark, sf_dir):
    tools = ledger.by_tool(view(spark, sf_dir, "ledger"))
    seen = table(spark, sf_dir, "events").where("value > 0")
    seen = seen.select(F.when(F.col("user_id") % 3 != 0, F.col("event_type")).alias("server"), F.concat(F.lit("t"), F.col("user_id") % 4).alias("tool"))
    return ledger.blind_spots(tools, seen).select("server", "tool", "blocks", "raw_tokens").orderBy(F.desc("raw_tokens"), "server", "tool")


@query("run_trend", f"""
WITH r AS (SELECT ts // 86400 AS day, sum(raw_tokens) AS r, sum(out_tokens) AS o FROM ledger WHERE {_RESULT} AND {_KNOWN} GROUP BY 1),
  p AS (SELECT 'all' AS label, CAST(day AS BIGINT) AS ts, CASE WHEN day % 9 <> 0 THEN CAST(((r - o) * 10000) // r AS BIGINT) END AS saved_pct FROM r)
SELECT ts, saved_pct, saved_pct - lag(saved_pct) OVER (ORDER BY ts) AS delta_points FROM p""", ("ledger",))  # fmt: skip
def run_trend(spark, sf_dir):
    rows = ledger.results(view(spark, sf_dir, "ledger")).where("known").groupBy((F.expr("ts div 86400")).alias("ts"))
    runs = rows.agg(F.sum("raw_tokens").alias("r"), F.sum("out_tokens").alias("o"))
    runs = runs.select(F.lit("all").alias("label"), "ts", F.expr("case when ts % 9 <> 0 then (r - o) * 10000 div r end").alias("saved_pct"))
    return ledger.trend(runs).select("ts", "saved_pct", "delta_points")


# --- corpus -------------------------------------------------------------------


@query("dedupe_first_sighting", """
SELECT tool, sha, count(*) AS sightings, min(captured_at) AS captured_at, arg_min(server, captured_at) AS server
FROM payloads GROUP BY 1, 2""", ("payloads",))  # fmt: skip
def dedupe_first_sighting(spark, sf_dir):
    rows = view(spark, sf_dir, "payloads").select("tool", "sha", "captured_at", F.coalesce("server", F.lit("")).alias("server"))
    rows = corpus.first_sightings(rows)
    return rows.select("tool", "sha", "sightings", "captured_at", "server")


ORACLE_SQL["dedupe_first_sighting"] = ORACLE_SQL["dedupe_first_sighting"].replace("arg_min(server,", "arg_min(coalesce(server, ''),")


@query("retention_topn", """
SELECT tool, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY tool ORDER BY captured_at DESC, sha) AS n FROM payloads) WHERE n <= 200""", ("payloads",))
def retention_topn(spark, sf_dir):
    return corpus.newest(view(spark, sf_dir, "payloads")).select("tool", "doc_id")


@query("coverage", """
SELECT tool, shape, count(*) AS payloads FROM (SELECT tool, CASE WHEN length(raw) >= 2000 THEN 'long-text' ELSE 'other' END AS shape FROM payloads)
GROUP BY GROUPING SETS ((tool), (shape), ())""", ("payloads",))  # fmt: skip
def coverage(spark, sf_dir):
    rows = view(spark, sf_dir, "payloads")
    return corpus.coverage(rows, P.shape_of_text(F.col("raw"))).drop("level")


@query("attribution", """
WITH s AS (SELECT *, min(server) OVER (PARTITION BY tool) AS a, max(server) OVER (PARTITION BY tool) AS b FROM t)
SELECT doc_id, CASE WHEN server IS NOT NULL THEN 'recorded' WHEN a = b THEN 'adopted' ELSE 'unknown' END AS how, coalesce(server, CASE WHEN a = b THEN a END) AS server
FROM s""")  # fmt: skip
def attribution(spark, sf_dir):
    rows = view(spark, sf_dir, "payloads").withColumn("tool", F.concat(F.lit("t"), F.col("doc_id") % 97))
    rows = rows.withColumn("server", F.when(F.col("doc_id") % 97 < 50, F.when(F.col("server").isNotNull(), "only")).otherwise(F.col("server")))
    return corpus.attribution(rows).select("doc_id", "how", "server")


ORACLE_SQL["attribution"] = ORACLE_SQL["attribution"].replace("WITH s AS", with_views("payloads").rstrip() + """, t AS (
  SELECT doc_id, 't' || (doc_id % 97) AS tool, CASE WHEN doc_id % 97 < 50 THEN CASE WHEN server IS NOT NULL THEN 'only' END ELSE server END AS server FROM payloads), s AS""", 1)  # fmt: skip


@query("shape_text_branch", "SELECT doc_id, CASE WHEN length(text) >= 2000 THEN 'long-text' ELSE 'other' END AS shape FROM documents")
def shape_text_branch(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", P.shape_of_text(F.col("text")).alias("shape"))


@query("payload_ids", "SELECT doc_id, sha, greatest(1, length(raw) // 4) AS tokens FROM payloads", ("payloads",))
def payload_ids(spark, sf_dir):
    return view(spark, sf_dir, "payloads").select("doc_id", P.payload_id(F.col("raw")).alias("sha"), P.token_count(F.col("raw")).alias("tokens"))


@query("gap_span_groups")
def gap_span_groups(spark, sf_dir):
    """Over all events; a recursive twin would take hours, so tests hold it against a plain fold."""
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("tool"), P.payload_id(F.col("event_id").cast("string")).alias("sha"), (F.col("event_id") * 1000003 % 7919 * 12000000).alias("captured_at"))
    return corpus.group_by_pause(rows)


@query("server_of_tool", """
SELECT doc_id, coalesce(server, CASE WHEN regexp_extract(tool, '^[^._]*') <> '' THEN regexp_extract(tool, '^[^._]*') ELSE 'other' END) AS origin
FROM (SELECT doc_id, server, CASE doc_id % 3 WHEN 0 THEN tool || '.read_it' WHEN 1 THEN '_' || tool ELSE tool END AS tool FROM payloads)""", ("payloads",))  # fmt: skip
def server_of_tool(spark, sf_dir):
    rows = view(spark, sf_dir, "payloads")
    tool = F.when(F.col("doc_id") % 3 == 0, F.concat(F.col("tool"), F.lit(".read_it"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("_"), F.col("tool"))).otherwise(F.col("tool"))
    return rows.select("doc_id", P.server_of_tool(tool, F.col("server")).alias("origin"))


# --- policy -------------------------------------------------------------------

POLICY = {
    "version": 1,
    "rules": [
        {"tool": "src1.*", "tiers": ["minify"]}, {"tool": "e?", "tiers": ["minify", "tabularize"]}, {"tool": "src[2-5].f*", "tiers": []},
        {"tool": "*", "tiers": ["minify", "dictionary"]},
    ],
}


@query("policy_select", """
SELECT doc_id, CASE WHEN starts_with(server || '.' || tool, 'src1.') THEN 0
    WHEN regexp_full_match(server || '.' || tool, 'src[2-5]\\.f.*') THEN 2 WHEN server IS NOT NULL THEN 3
    WHEN regexp_full_match(tool, 'e.') THEN 1 ELSE 3 END AS ord
FROM payloads""", ("payloads",))  # fmt: skip
def policy_select(spark, sf_dir):
    rows = view(spark, sf_dir, "payloads")
    return policy.select_rules(rows, policy.rules_table(spark, POLICY)).select("doc_id", "ord")


_NAMES = ["result[].bodyText", "user_id", "createdTime", "a.b.note-text", "principle", "httpStatus", "blurb", "x[]"]


@query("field_role", """
SELECT * FROM (VALUES ('result[].bodyText', 'prose'), ('user_id', 'identity'), ('createdTime', 'identity'), ('a.b.note-text', 'prose'),
  ('principle', 'unknown'), ('httpStatus', 'identity'), ('blurb', 'prose'), ('x[]', 'unknown')) t(name, role)""")  # fmt: skip
def field_role(spark, sf_dir):
    return spark.createDataFrame([(n,) for n in _NAMES], "name string").withColumn("role", P.field_role(F.col("name")))


@query("launcher_and_sensitive", """
SELECT * FROM (VALUES ('npx', true, false), ('Python3.12.exe', true, false), ('pymcp', false, false), ('gmail-box', false, true), ('webdriver', false, false),
  ('my drive', false, true), ('openapi', false, false), ('op', false, true)) t(name, launcher, sensitive)""")  # fmt: skip
def launcher_and_sensitive(spark, sf_dir):
    names = ["npx", "Python3.12.exe", "pymcp", "gmail-box", "webdriver", "my drive", "openapi", "op"]
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    return rows.select("name", P.is_launcher(F.col("name")).alias("launcher"), P.never_lossy(F.col("name"), []).alias("sensitive"))


@query("tier_decision", """
SELECT tool, CASE WHEN gate_fail > 0 OR pct < 5 THEN '' ELSE 'minify,tabularize' || CASE WHEN dict * 100.0 / raw >= 5 THEN ',dictionary' ELSE '' END END AS tiers
FROM (SELECT event_type || '-' || (user_id % 9) AS tool, count(*) FILTER (WHERE event_id % 997 = 0) AS gate_fail, sum(event_id % 90) AS raw,
  sum(event_id % 13) AS dict, sum(event_id % (user_id % 9 + 2)) * 100.0 / sum(event_id % 90) AS pct FROM events GROUP BY 1)""")  # fmt: skip
def tier_decision(spark, sf_dir):
    rows = table(spark, sf_dir, "events").groupBy(F.concat_ws("-", "event_type", F.col("user_id") % 9).alias("tool")).agg(
        F.count_if(F.col("event_id") % 997 == 0).alias("gate_fail"), F.lit(0).alias("emb_fail"), F.sum(F.col("event_id") % 90).alias("raw_tok"),
        F.sum(F.col("event_id") % (F.col("user_id") % 9 + 2)).alias("total"), F.sum(F.col("event_id") % 13).alias("dictionary"), F.lit(0).alias("embedded"), F.lit(0).alias("rebased_total"),
    )
    return policy.decide_tiers(rows).select("tool", F.array_join("tiers", ",").alias("tiers"))


# --- probes -------------------------------------------------------------------

_TOK = "greatest(1, length({}) // 4)"


@query("value_redundancy", f"""
SELECT payload, CAST(sum(n) AS BIGINT) AS cells, count(*) AS distinct_values, CAST(sum(t * n) AS BIGINT) AS total_value_tokens,
  CAST(sum(t * (n - 1)) AS BIGINT) AS redundant_value_tokens, CAST(sum(greatest(0, t - 1) * (n - 1)) AS BIGINT) AS est_dict_saving_tokens,
  sum(t * (n - 1)) / sum(t * n) AS redundancy_ratio
FROM (SELECT payload, value, count(*) AS n, {_TOK.format("value")} AS t FROM cells GROUP BY 1, 2) GROUP BY 1""", ("cells",))  # fmt: skip
def value_redundancy(spark, sf_dir):
    return probes.value_redundancy(view(spark, sf_dir, "cells"), "payload")


@query("field_profiles", f"""
SELECT payload, key, n, distinct_values, tokens, max_tok, distinct_values / n AS uniq_ratio, tokens / n AS mean_tok, tokens / sum(tokens) OVER (PARTITION BY payload) AS tok_share
FROM (SELECT payload, key, count(*) AS n, count(DISTINCT value) AS distinct_values, CAST(sum({_TOK.format("value")}) AS BIGINT) AS tokens, max({_TOK.format("value")}) AS max_tok
  FROM cells GROUP BY 1, 2)""", ("cells",))  # fmt: skip
def field_profiles(spark, sf_dir):
    return probes.field_profiles(view(spark, sf_dir, "cells"))


_STREAM = "regexp_extract_all(raw, '[A-Za-z]+|[0-9]+|[^A-Za-z0-9\\s]')"


@query("token_idf", f"""
SELECT token, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest({_STREAM}) AS token FROM payloads) GROUP BY 1""", ("payloads",))
def token_idf(spark, sf_dir):
    rows = view(spark, sf_dir, "payloads")
    return probes.token_idf(probes.token_dfs(rows, "doc_id", "raw"), rows.count()).select("token", "df")


_PAIRS = "p AS (SELECT lag(doc_id) OVER (PARTITION BY tool ORDER BY sha, doc_id) AS prev, doc_id AS curr FROM payloads)"


def _pairs(rows):
    return sequence.pairs(rows.select("tool", "sha", "doc_id"), "tool", "sha", "doc_id", value="doc_id").select("prev", F.col("doc_id").alias("curr"))


@query("pair_overlap", f"""
WITH {_PAIRS}, c AS (SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest({_STREAM}) AS token FROM payloads) GROUP BY 1, 2)
SELECT p.prev, p.curr, CAST(sum(a.n) AS BIGINT) AS curr_tokens, CAST(sum(least(a.n, coalesce(b.n, 0))) AS BIGINT) AS shared_tokens,
  sum(least(a.n, coalesce(b.n, 0))) / sum(a.n) AS overlap_ratio
FROM p JOIN c a ON a.doc_id = p.curr LEFT JOIN c b ON b.doc_id = p.prev AND b.token = a.token WHERE p.prev IS NOT NULL GROUP BY 1, 2""", ("payloads",))  # fmt: skip
def pair_overlap(spark, sf_dir):
    rows = view(spark, sf_dir, "payloads")
    return probes.pair_overlap(_pairs(rows), rows, "doc_id", "raw")


@query("pair_overlap_idf", f"""
WITH {_PAIRS}, c AS (SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest({_STREAM}) AS token FROM payloads) GROUP BY 1, 2),
  i AS (SELECT token, ln((SELECT count(*) FROM payloads) / count(*)) AS idf FROM c GROUP BY 1)
SELECT p.prev, p.curr, CAST(round(sum(least(a.n, coalesce(b.n, 0)) * idf) * 1000) AS BIGINT) AS shared_milli, CAST(round(sum(a.n * idf) * 1000) AS BIGINT) AS curr_milli
FROM p JOIN c a ON a.doc_id = p.curr LEFT JOIN c b ON b.doc_id = p.prev AND b.token = a.token JOIN i ON i.token = a.token WHERE p.prev IS NOT NULL GROUP BY 1, 2""", ("payloads",))  # fmt: skip
def pair_overlap_idf(spark, sf_dir):
    rows = view(spark, sf_dir, "payloads")
    many = rows.count()
    common = probes.token_idf(probes.token_dfs(rows, "doc_id", "raw"), many).where("df > 1")  # all others weigh ln N
    out = probes.pair_overlap(_pairs(rows), rows, "doc_id", "raw", common, F.log(F.lit(many).cast("double")))
    milli = lambda c: F.round(F.col(c) * 1000).cast("long")
    return out.select("prev", "curr", milli("shared_weight").alias("shared_milli"), milli("curr_weight").alias("curr_milli"))


@query("cross_server_redundancy", f"""
WITH b AS (SELECT server, value, count(*) AS n FROM (SELECT payload % 7 AS server, value FROM cells) GROUP BY 1, 2),
  v AS (SELECT value, sum(n) AS n, sum(n - 1) AS w, {_TOK.format("value")} AS t FROM b GROUP BY value)
SELECT CAST(sum(greatest(0, t - 1) * w) AS BIGINT) AS per_peer_saving_tokens, CAST(sum(greatest(0, t - 1) * (n - 1)) AS BIGINT) AS pooled_saving_tokens,
  CAST(sum(t * n) AS BIGINT) AS pooled_total_value_tokens, CAST(sum(greatest(0, t - 1) * (n - 1 - w)) AS BIGINT) AS cross_server_increment_tokens FROM v""", ("cells",))  # fmt: skip
def cross_server_redundancy(spark, sf_dir):
    cells = view(spark, sf_dir, "cells").select((F.col("payload") % 7).alias("server"), F.concat(F.col("value")).alias("value"))
    return probes.cross_server_redundancy(cells).select("per_peer_saving_tokens", "pooled_saving_tokens", "pooled_total_value_tokens", "cross_server_increment_tokens")


_SERVER_PAIRS = """
r AS (SELECT server, doc_id, row_number() OVER (PARTITION BY server ORDER BY sha, doc_id) AS n FROM payloads WHERE server IS NOT NULL),
q AS (SELECT a.server AS a, b.server AS b, a.doc_id AS prev, b.doc_id AS curr FROM r a JOIN r b ON a.n = b.n AND a.server < b.server WHERE a.n <= 20),
c AS (SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest({}) AS token FROM payloads) GROUP BY 1, 2)""".format(_STREAM)


@query("cross_server_overlap", f"""
WITH {_SERVER_PAIRS}, s AS (SELECT q.a, q.b, q.prev, q.curr, sum(least(x.n, coalesce(y.n, 0))) / sum(x.n) AS ratio
  FROM q JOIN c x ON x.doc_id = q.curr LEFT JOIN c y ON y.doc_id = q.prev AND y.token = x.token GROUP BY 1, 2, 3, 4),
z AS (SELECT a, b, ratio, row_number() OVER (PARTITION BY a, b ORDER BY ratio) AS n, count(*) OVER (PARTITION BY a, b) AS m FROM s)
SELECT a, b, ratio AS upper_median FROM z WHERE n = m // 2 + 1""", ("payloads",))  # fmt: skip
def cross_server_overlap(spark, sf_dir):
    rows = view(spark, sf_dir, "payloads").withColumn("id", F.col("doc_id"))
    pairs = probes.server_pairs(rows)
    chosen = pairs.select(F.explode(F.array("prev", "curr")).alias("id")).distinct()
    overlap = probes.pair_overlap(pairs.select("prev", "curr"), rows.join(chosen, "id", "left_semi"), "doc_id", "raw")
    return probes.upper_median_of(pairs.join(overlap, ["prev", "curr"]), "overlap_ratio", "a", "b")


@query("upper_median", """
SELECT source, n_chars AS upper_median FROM (
  SELECT source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars) AS n, count(*) OVER (PARTITION BY source) AS m FROM documents) WHERE n = m // 2 + 1""")
def upper_median(spark, sf_dir):
    return probes.upper_median_of(table(spark, sf_dir, "documents"), "n_chars", "source")


@query("probe_verdict", """
SELECT user_id AS k, CASE WHEN sum(event_id % 3) = 0 THEN 'inconclusive' WHEN count(*) < 30 THEN 'thin' WHEN avg(event_id % 100) / 500 < 0.03 THEN 'close'
  WHEN avg(event_id % 100) / 500 >= 0.10 THEN 'build' ELSE 'marginal' END AS verdict FROM events GROUP BY 1""")
def probe_verdict(spark, sf_dir):
    rows = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("lists"), (F.avg(F.col("event_id") % 100) / 500).alias("inc"), F.sum(F.col("event_id") % 3).alias("tokens"))
    return rows.select("k", probes.increment_verdict(F.col("inc"), F.col("lists"), F.col("tokens")).alias("verdict"))


@query("line_dictionary", """
SELECT id, count(*) AS aliases, CAST(sum(n * t - (n + 1 + t)) AS BIGINT) AS saved_tokens
FROM (SELECT id, line, count(*) AS n, greatest(1, length(line) // 4) AS t FROM (SELECT doc_id AS id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> '' GROUP BY 1, 2)
WHERE n > 1 AND n * t - (n + 1 + t) > 0 GROUP BY 1""")  # fmt: skip
def line_dictionary(spark, sf_dir):
    return probes.line_dictionary(table(spark, sf_dir, "documents"), "doc_id", "text")


# --- snapshots ----------------------------------------------------------------


@query("snapshot_row_diff", """
SELECT coalesce(p.k, c.k) AS k, CASE WHEN c.k IS NULL THEN 'del' WHEN p.k IS NULL THEN 'new' WHEN p.status IS DISTINCT FROM c.status OR p.priority IS DISTINCT FROM c.priority THEN 'set' ELSE 'same' END AS op,
  p.status AS old_status, c.status AS new_status FROM snap_prev p FULL JOIN snap_curr c ON p.k = c.k""", ("snap_prev", "snap_curr"))  # fmt: skip
def snapshot_row_diff(spark, sf_dir):
    rows = snapshot.row_diff(view(spark, sf_dir, "snap_prev"), view(spark, sf_dir, "snap_curr"), "k")
    return rows.select("k", "op", F.col("old.status").alias("old_status"), F.col("new.status").alias("new_status"))


@query("snapshot_row_apply", "SELECT k, status, priority FROM snap_curr", ("snap_curr",))
def snapshot_row_apply(spark, sf_dir):
    prev, curr = view(spark, sf_dir, "snap_prev"), view(spark, sf_dir, "snap_curr")
    return snapshot.row_apply(prev, snapshot.row_diff(prev, curr, "k"), "k")


@query("snapshot_keeps_order", "SELECT true AS representable")
def snapshot_keeps_order(spark, sf_dir):
    """All orders: every eleventh key is removed, every seventh is new and comes after the rest."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    new = F.col("k") % 7 == 0
    prev = orders.where(~new).select("k", F.col("k").alias("ord"))
    curr = orders.where(new | (F.col("k") % 11 != 0)).select("k", F.when(new, F.col("k")).otherwise(F.col("k") - F.lit(1 << 62)).alias("ord"))
    return snapshot.keeps_order(prev, curr, "k", "ord")


_KEYED = """
a AS (SELECT o_orderkey AS id, 'status' AS key, o_orderstatus AS value FROM orders WHERE o_orderkey % 7 <> 0 UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM orders),
b AS (SELECT o_orderkey AS id, 'status' AS key, o_orderstatus AS value FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT o_orderkey, 'priority', o_orderpriority || CASE WHEN o_orderkey % 3 = 0 THEN '!' ELSE '' END FROM orders)"""


def _keyed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    both = lambda status, priority: status.select(F.col("o_orderkey").alias("id"), F.lit("status").alias("key"), F.col("o_orderstatus").alias("value")).unionByName(orders.select(F.col("o_orderkey").alias("id"), F.lit("priority").alias("key"), priority.alias("value")))
    prev = both(orders.where("o_orderkey % 7 <> 0"), F.col("o_orderpriority"))
    curr = both(orders.where("o_orderkey % 5 <> 0"), F.concat(F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 3 == 0, "!").otherwise("")))
    return prev, curr


@query("key_diff", f"""
WITH {_KEYED} SELECT id, key, op, value FROM (
  SELECT coalesce(a.id, b.id) AS id, coalesce(a.key, b.key) AS key, CASE WHEN b.id IS NULL THEN 'del' WHEN a.id IS NULL OR a.value IS DISTINCT FROM b.value THEN 'set' END AS op, b.value AS value
  FROM a FULL JOIN b ON a.id = b.id AND a.key = b.key) WHERE op IS NOT NULL""")  # fmt: skip
def key_diff(spark, sf_dir):
    return snapshot.key_diff(*_keyed(spark, sf_dir))


@query("key_apply", f"WITH {_KEYED} SELECT * FROM b")
def key_apply(spark, sf_dir):
    prev, curr = _keyed(spark, sf_dir)
    return snapshot.key_apply(prev, snapshot.key_diff(prev, curr))


@query("diff_key_discovery", """
SELECT * FROM (VALUES (0, 'o_orderkey', true), (1, 'o_custkey', false), (2, 'o_orderstatus', false), (3, 'o_totalprice', false), (4, 'o_orderdate', false), (5, 'o_orderpriority', false)) t(ordinal, "column", usable)""")
def diff_key_discovery(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return snapshot.diff_key_discovery(orders.where("o_orderkey % 7 <> 0"), orders.where("o_orderkey % 11 <> 0"))


# --- sequences ----------------------------------------------------------------


@query("sliding_pairs", "SELECT conv_id, turn, sha1(raw) AS h, sha1(prev) AS hp FROM (SELECT *, lag(raw) OVER (PARTITION BY conv_id ORDER BY sha, turn) AS prev FROM turns) WHERE prev IS NOT NULL", ("turns",))
def sliding_pairs(spark, sf_dir):
    rows = sequence.pairs(view(spark, sf_dir, "turns"), "conv_id", "sha", "turn")
    return rows.select("conv_id", "turn", F.sha1(F.col("raw").cast("binary")).alias("h"), F.sha1(F.col("prev").cast("binary")).alias("hp"))


@query("chronological_pairs", "SELECT conv_id, turn, length(raw) - length(prev) AS growth FROM (SELECT *, lag(raw) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM turns) WHERE prev IS NOT NULL", ("turns",))
def chronological_pairs(spark, sf_dir):
    rows = sequence.pairs(view(spark, sf_dir, "turns"), "conv_id", "turn")
    return rows.select("conv_id", "turn", (F.length("raw") - F.length("prev")).cast("long").alias("growth"))


_LINKED = "length(raw) % 3 <> 0"


@query("islands", f"SELECT conv_id, turn, CAST(sum(CASE WHEN {_LINKED} THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS island FROM turns", ("turns",))
def islands(spark, sf_dir):
    rows = view(spark, sf_dir, "turns")
    return sequence.islands(rows, "conv_id", "turn", linked=F.length("raw") % 3 != 0).select("conv_id", "turn", "island")


@query("chain_windows", f"""
WITH i AS (SELECT conv_id, turn, sha, sum(CASE WHEN {_LINKED} THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM turns),
  w AS (SELECT conv_id, CAST(island AS BIGINT) AS island, row_number() OVER r - 1 AS place, lead(sha, 1) OVER r AS s1, lead(sha, 2) OVER r AS s2, sha FROM i WINDOW r AS (PARTITION BY conv_id, island ORDER BY turn))
SELECT conv_id, island, place, concat(sha, ',', s1, ',', s2) AS chain FROM w WHERE place % 2 = 0 AND s2 IS NOT NULL""", ("turns",))  # fmt: skip
def chain_windows(spark, sf_dir):
    rows = sequence.islands(view(spark, sf_dir, "turns"), "conv_id", "turn", linked=F.length("raw") % 3 != 0)
    rows = sequence.chain_windows(rows, 2, "conv_id", "island", order="turn", value="sha")
    return rows.select("conv_id", "island", F.col("place").cast("long").alias("place"), F.array_join("window_values", ",").alias("chain"))


@query("round_robin_cap", """
SELECT role, conv_id, turn FROM (SELECT role, conv_id, turn, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS n FROM turns) ORDER BY n, role LIMIT 60""", ("turns",))
def round_robin_cap(spark, sf_dir):
    return sequence.round_robin(view(spark, sf_dir, "turns"), 60, "role", "conv_id", "turn").select("role", "conv_id", "turn")


@query("expose_names", """
WITH t AS (SELECT DISTINCT p_brand AS peer, p_type AS name FROM part), n AS (SELECT name, count(*) AS owners FROM t GROUP BY 1)
SELECT peer, name, CASE WHEN owners > 1 THEN peer || '__' || name ELSE name END AS exposed FROM t JOIN n USING (name)""")
def expose_names(spark, sf_dir):
    return sequence.expose_names(table(spark, sf_dir, "part").select(F.col("p_brand").alias("peer"), F.col("p_type").alias("name")))


# --- lossy --------------------------------------------------------------------


@query("truncate_text", "SELECT doc_id, CASE WHEN length(text) > 120 THEN substr(text, 1, 120) || '…⟨+' || (length(text) - 120) || ' chars⟩' ELSE text END AS cut FROM documents")
def truncate_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", P.truncate(F.col("text")).alias("cut"))


def _dropped(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("length(text) >= 200")
    return docs.select("doc_id", P.drop_handle(F.col("lang"), F.lit("$.text"), F.col("text")).alias("handle"), F.length("text").cast("long").alias("chars"), "text")


@query("drop_large_text", """
SELECT doc_id, chars, substr(sha1('["' || lang || '", "$.text", "' || replace(replace(text, chr(92), chr(92) || chr(92)), '"', chr(92) || '"') || '"]'), 1, 16) AS handle
FROM (SELECT *, length(text) AS chars FROM documents) WHERE chars >= 200""")
def drop_large_text(spark, sf_dir):
    return _dropped(spark, sf_dir).select("doc_id", "handle", "chars")


@query("drop_restore_gate", "SELECT doc_id, text FROM documents WHERE length(text) >= 200")
def drop_restore_gate(spark, sf_dir):
    markers = _dropped(spark, sf_dir)
    store = markers.groupBy("handle").agg(F.first("text").alias("value"))
    return markers.select("doc_id", "handle").join(store, "handle").select("doc_id", F.col("value").alias("text"))


# --- evaluation ---------------------------------------------------------------

_ACC = """
SELECT model, n, CAST(t AS BIGINT) AS trials, k / t AS acc,
  CASE WHEN n > 1 THEN CAST(round(1e6 * sqrt(n / (n - 1) * greatest(0.0, kk - 2 * (k / t) * kt + (k / t) * (k / t) * tt)) / t) AS BIGINT) ELSE CAST(round(1e6 * sqrt(t * (k / t) * (1 - k / t)) / t) AS BIGINT) END AS se_micro
FROM (SELECT model, count(*) AS n, sum({0}::DOUBLE) AS k, sum(trials::DOUBLE) AS t, sum({0}::DOUBLE * {0}) AS kk, sum({0}::DOUBLE * trials) AS kt, sum(trials::DOUBLE * trials) AS tt FROM eval_rows WHERE trials > 0 GROUP BY 1)"""


@query("accuracy_se", _ACC.format("form_ok"), ("eval_rows",))
def accuracy_se(spark, sf_dir):
    rows = evaluation.accuracy(view(spark, sf_dir, "eval_rows"), "form_ok", "model")
    return rows.select("model", "n", "trials", "acc", F.round(F.col("se") * 1e6).cast("long").alias("se_micro"))


_GAP = "SELECT model, CAST(round(1e6 * (sum(form_ok) / sum(trials) - sum(control_ok) / sum(trials))) AS BIGINT) AS gap_micro FROM eval_rows WHERE trials > 0 GROUP BY 1"


@query("paired_gap", _GAP, ("eval_rows",))
def paired_gap(spark, sf_dir):
    return evaluation.gaps(view(spark, sf_dir, "eval_rows"), "model").select("model", F.round(F.col("gap") * 1e6).cast("long").alias("gap_micro"))


@query("worst_case_gate", f"SELECT model, gap_micro, gap_micro >= -50000 AS passed FROM ({_GAP}) ORDER BY gap_micro, model LIMIT 1", ("eval_rows",))
def worst_case_gate(spark, sf_dir):
    return evaluation.worst_case(evaluation.gaps(view(spark, sf_dir, "eval_rows"), "model")).select("model", F.round(F.col("gap") * 1e6).cast("long").alias("gap_micro"), "passed")


@query("codec_verdict", """
SELECT model, b, CAST(sum(trials) AS BIGINT) AS trials, CAST(sum(greatest(0, control_ok - form_ok)) AS BIGINT) AS excess_misses,
  CASE WHEN sum(greatest(0, control_ok - form_ok)) > 0 THEN 'UNSAFE' WHEN sum(trials) >= 20 THEN 'SAFE' ELSE 'UNRESOLVED' END AS verdict
FROM (SELECT *, question % 50 AS b FROM eval_rows) GROUP BY 1, 2""", ("eval_rows",))  # fmt: skip
def codec_verdict(spark, sf_dir):
    return evaluation.codec_verdict(view(spark, sf_dir, "eval_rows").withColumn("b", F.col("question") % 50), "model", "b")


@query("regressions", "SELECT model, count(*) FILTER (WHERE control_ok = trials AND form_ok < trials) AS regressions FROM eval_rows GROUP BY 1", ("eval_rows",))
def regressions(spark, sf_dir):
    return evaluation.regressions(view(spark, sf_dir, "eval_rows"), "model")


@query("ab_modal_turns", """
WITH r AS (SELECT conv_id, CASE WHEN conv_id % 2 = 0 THEN 'a' ELSE 'b' END AS arm, count(*) AS turns, sum(length(raw)) AS chars FROM turns GROUP BY 1, 2),
  m AS (SELECT arm, turns, row_number() OVER (PARTITION BY arm ORDER BY count(*) DESC, turns) AS n FROM r GROUP BY 1, 2)
SELECT r.arm, r.turns, count(*) AS runs, CAST(sum(chars) AS BIGINT) AS chars FROM r JOIN m ON r.arm = m.arm AND r.turns = m.turns AND m.n = 1 GROUP BY 1, 2""", ("turns",))  # fmt: skip
def ab_modal_turns(spark, sf_dir):
    runs = view(spark, sf_dir, "turns").groupBy("conv_id", F.when(F.col("conv_id") % 2 == 0, "a").otherwise("b").alias("arm")).agg(F.count(F.lit(1)).alias("turns"), F.sum(F.length("raw")).alias("chars"))
    return sequence.modal_turns(runs).groupBy("arm", "turns").agg(F.count(F.lit(1)).alias("runs"), F.sum("chars").alias("chars"))


@query("ab_session_cost", """
SELECT arm, count(*) AS n, CAST(round(avg(c) * 1000) AS BIGINT) AS mean_milli, CAST(round(stddev_samp(c) * 1000) AS BIGINT) AS sd_milli FROM (
  SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS arm, (o_custkey % 50) * 1.0 + (o_custkey % 7) * 1.25 + (o_custkey % 90) * 0.1 + (o_orderkey % 11) * 5.0 AS c FROM orders) GROUP BY 1""")
def ab_session_cost(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    runs = orders.select(F.when(F.col("o_orderkey") % 2 == 0, "a").otherwise("b").alias("arm"), (F.col("o_custkey") % 50).alias("input"), (F.col("o_custkey") % 7).alias("cache_write"), (F.col("o_custkey") % 90).alias("cache_read"), (F.col("o_orderkey") % 11).alias("output"))
    milli = lambda c: F.round(F.col(c) * 1000).cast("long")
    return evaluation.ab_sessions(runs).select("arm", "n", milli("mean_cost").alias("mean_milli"), milli("sd_cost").alias("sd_milli"))

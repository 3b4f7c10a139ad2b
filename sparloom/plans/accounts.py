"""Queries of labels, liability, arms, peers and whole sessions, with their DuckDB twins where SQL can say them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..operators import broadcast, corpus, evaluation, ledger, liability, probes
from ..operators import payloads as ops
from ..sources.views import table, view
from ..streaming import machines, pipeline, run
from .payload_queries import _streamed, record_payloads
from .relational import _CANON, _RESULT, _SUMS, query

# --- scalars ------------------------------------------------------------------


@query("percent_saved", f"""
SELECT server, tool, CASE WHEN raw_tokens <> 0 THEN CAST(round((raw_tokens - out_tokens) * 100000.0 / raw_tokens) AS BIGINT) END AS saved_milli
FROM (SELECT server, {_CANON} AS tool, {_SUMS} FROM ledger WHERE {_RESULT} GROUP BY ALL)""", ("ledger",))
def percent_saved(spark, sf_dir):
    tools = ledger.by_tool(view(spark, sf_dir, "ledger"))
    return tools.select("server", "tool", F.round(P.percent_saved(F.col("raw_tokens"), F.col("out_tokens")) * 1000).cast("long").alias("saved_milli"))


@query("base36", "SELECT o_orderkey, lower(to_base(o_orderkey, 36)) AS alias FROM orders")
def base36(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", P.base36(F.col("o_orderkey")).alias("alias"))


@query("redact_headers", """
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Authorization: ***' WHEN 1 THEN 'x-api-key=***' ELSE 'Accept: ' || c_name END AS header FROM customer""")
def redact_headers(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    head = F.when(F.col("c_custkey") % 3 == 0, "Authorization: Bearer ").when(F.col("c_custkey") % 3 == 1, "x-api-key=").otherwise("Accept: ")
    return rows.select("c_custkey", P.redact(F.concat(head, F.col("c_name"))).alias("header"))


_COMMANDS = """
SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN '/opt/bin/' || lower(s_name) || ' --port 1' WHEN 1 THEN 'https://' || s_suppkey || '.example.org:8080/mcp?x=1' WHEN 2 THEN 'python3 -m server' WHEN 3 THEN 'srv-' || (s_suppkey % 7) ELSE '' END AS wraps FROM supplier"""


@query("server_labels", f"""
SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN split_part(lower(s_name), ' ', 1) WHEN 1 THEN s_suppkey || '.example.org:8080' WHEN 2 THEN 'python3' WHEN 3 THEN 'srv-' || (s_suppkey % 7) ELSE 'unknown' END AS label FROM ({_COMMANDS})
JOIN supplier USING (s_suppkey)""")
def server_labels(spark, sf_dir):
    rows = spark.sql(_COMMANDS.replace("FROM supplier", "FROM {supplier}"), supplier=table(spark, sf_dir, "supplier"))
    return rows.select("s_suppkey", liability.server_label(F.col("wraps")).alias("label"))


# --- corpus -------------------------------------------------------------------


@query("identities", """
WITH s AS (SELECT tool, min(server) AS lo, max(server) AS hi FROM payloads WHERE server <> '' GROUP BY 1)
SELECT DISTINCT CASE WHEN sv IS NULL THEN tool ELSE sv || '.' || tool END AS name, tool, sv AS server
FROM (SELECT p.tool, coalesce(nullif(p.server, ''), CASE WHEN lo = hi THEN lo END) AS sv FROM payloads p LEFT JOIN s ON s.tool = p.tool)""", ("payloads",))
def identities(spark, sf_dir):
    return corpus.identities(view(spark, sf_dir, "payloads"))


@query("heuristic_share", "SELECT count(*) FILTER (WHERE doc_id % 3 <> 0 AND doc_id % 7 <> 0) AS guessed, count(*) AS payloads FROM documents")
def heuristic_share(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 3 == 0, "r").alias("result_id"), F.when(F.col("doc_id") % 7 != 0, F.col("doc_id")).alias("captured_at"))
    return corpus.heuristic_share(rows)


@query("result_groups", """
SELECT lang AS tool, CAST(doc_id // 3 AS VARCHAR) AS result_id, count(*) AS blocks, min(doc_id) AS first FROM documents GROUP BY 1, 2""")
def result_groups(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("lang").alias("tool"), F.expr("doc_id div 3").cast("string").alias("result_id"), F.col("doc_id").alias("captured_at"), F.col("text").alias("raw"))
    return corpus.group_by_result(rows).select("tool", "result_id", F.size("blocks").cast("long").alias("blocks"), F.col("blocks")[0]["captured_at"].alias("first"))


@query("overlap_verdicts", """
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'inconclusive' WHEN p_size / 100.0 >= 0.15 THEN 'build' ELSE 'skip' END AS verdict FROM part""")
def overlap_verdicts(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", probes.overlap_verdict(F.when(F.col("p_size") % 4 != 0, F.col("p_size") / 100.0)).alias("verdict"))


# --- evaluation ---------------------------------------------------------------

_ARMS = """
SELECT l_returnflag || (l_suppkey % 4) AS model, l_partkey AS question, CASE WHEN l_partkey % 2 = 0 THEN 'table' ELSE 'table+dict' END AS transform, count(*) AS trials, count(*) AS attempts,
  CAST(sum(CASE WHEN l_suppkey % 4 = 1 AND l_linenumber > 2 THEN 1 ELSE 0 END) AS BIGINT) AS fails,
  CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS form_ok, count(*) - CASE WHEN l_partkey % 9 = 0 THEN 1 ELSE 0 END AS form_trials,
  CAST(sum(CASE WHEN l_quantity >= 20 THEN 1 ELSE 0 END) AS BIGINT) AS inline_ok, count(*) AS inline_trials,
  CAST(sum(CASE WHEN l_suppkey % 4 <> 3 AND l_quantity >= 10 THEN 1 ELSE 0 END) AS BIGINT) AS control_ok, count(*) AS control_trials
FROM lineitem GROUP BY l_returnflag, l_suppkey % 4, l_partkey"""


def _arms(spark, sf_dir):
    rows = spark.sql(_ARMS.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))
    return rows.withColumn("form_ok", F.least("form_ok", "form_trials"))


@query("arm_gaps", f"""
WITH r AS (SELECT * REPLACE (least(form_ok, form_trials) AS form_ok) FROM ({_ARMS})),
  u AS (SELECT model, sum(fails) / sum(attempts) > 0.2 OR sum(form_trials) = 0 AS unmeasured FROM r GROUP BY 1),
  p AS (SELECT * FROM r WHERE form_trials = trials),
  a AS (SELECT model, count(*) FILTER (WHERE trials > 0) AS n, sum(form_ok) / sum(trials) AS f, sum(inline_ok) / sum(trials) AS i, sum(control_ok) / sum(trials) AS c FROM p GROUP BY 1)
SELECT model, n, CASE WHEN f >= i THEN 'form' ELSE 'inline' END AS arm, CASE WHEN unmeasured THEN 'unmeasured' WHEN c = 0 THEN 'broken control' END AS excluded,
  CASE WHEN NOT unmeasured AND c <> 0 THEN CAST(round(1e6 * (greatest(f, i) - c)) AS BIGINT) END AS gap_micro FROM a JOIN u USING (model)""")
def arm_gaps(spark, sf_dir):
    rows = evaluation.arm_gaps(_arms(spark, sf_dir), ["form", "inline"], "control", "model")
    return rows.select("model", "n", "arm", "excluded", F.round(F.col("gap") * 1e6).cast("long").alias("gap_micro"))


@query("by_transform", f"""
SELECT model, transform, count(*) AS questions, CAST(round(1e6 * sum(least(form_ok, form_trials)) / sum(form_trials)) AS BIGINT) AS form_micro, CAST(round(1e6 * sum(control_ok) / sum(control_trials)) AS BIGINT) AS control_micro
FROM ({_ARMS}) GROUP BY 1, 2""")
def by_transform(spark, sf_dir):
    rows = evaluation.by_transform(_arms(spark, sf_dir), ["form", "control"], "model")
    return rows.select("model", "transform", "questions", *(F.round(F.col(f"{x}_acc") * 1e6).cast("long").alias(f"{x}_micro") for x in ("form", "control")))


@query("unmeasured", f"SELECT model, coalesce(sum(fails) / sum(attempts) > 0.2, false) AS unmeasured FROM ({_ARMS}) GROUP BY 1")
def unmeasured(spark, sf_dir):
    return evaluation.unmeasured(_arms(spark, sf_dir), "model").select("model", "unmeasured")


@query("ab_signal", """
WITH r AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS arm, (event_id % 50) * 1.0 + (event_id % 7) * 1.25 + (event_id % 11) * 0.1 + (CASE WHEN event_id % 2 = 0 THEN 10 ELSE 90 END) * 5.0 AS cost FROM events),
 s AS (SELECT arm, count(*) AS n, avg(cost) AS m, stddev_samp(cost) AS d FROM r GROUP BY 1)
SELECT CAST(round((b.m - a.m) * 1000) AS BIGINT) AS delta_milli, abs(b.m - a.m) > a.d + b.d AND a.n >= 2 AND b.n >= 2 AS signal FROM s a, s b WHERE a.arm = 'a' AND b.arm = 'b'""")
def ab_signal(spark, sf_dir):
    e = F.col("event_id")
    runs = table(spark, sf_dir, "events").select(F.when(e % 2 == 0, "a").otherwise("b").alias("arm"), (e % 50).alias("input"), (e % 7).alias("cache_write"), (e % 11).alias("cache_read"), F.when(e % 2 == 0, 10).otherwise(90).alias("output"))
    return evaluation.ab_signal(evaluation.ab_sessions(runs)).select(F.round(F.col("delta") * 1000).cast("long").alias("delta_milli"), "signal")


@query("bench_totals")
def bench_totals(spark, sf_dir):
    return evaluation.bench_totals(record_payloads(spark, sf_dir, "l_suppkey").select(ops.measure(F.col("raw")).alias("m")))


# --- peers --------------------------------------------------------------------

_REPLIES = """
SELECT o_custkey AS broadcast, o_orderkey AS peer, o_orderkey AS position,
  CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '{"error":{"code":-32601}}' WHEN 2 THEN '{"result":{"tools":[]}}' WHEN 3 THEN '{"result":{"tools":"none"}}'
    ELSE '{"result":{"tools":[{"name":"t' || (o_orderkey % 3) || '"},{"name":"all"}]}}' END AS reply FROM orders"""


def _replies(spark, sf_dir):
    return spark.sql(_REPLIES.replace("{", "{{").replace("}", "}}").replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))


@query("silent_peers", """
SELECT o_custkey AS broadcast, o_orderkey AS peer, CASE o_orderkey % 5 WHEN 0 THEN 'no reply' WHEN 1 THEN 'error' WHEN 2 THEN 'empty' ELSE 'malformed' END AS why FROM orders WHERE o_orderkey % 5 <> 4""")
def silent_peers(spark, sf_dir):
    return broadcast.silent_peers(_replies(spark, sf_dir), "tools").select("broadcast", "peer", "why")


@query("merged_lists", """
SELECT o_custkey AS broadcast, o_orderkey AS peer, unnest(['t' || (o_orderkey % 3), 'all']) AS name FROM orders WHERE o_orderkey % 5 = 4""")
def merged_lists(spark, sf_dir):
    return broadcast.merged_list(_replies(spark, sf_dir), "tools").select("broadcast", "peer", "name")


@query("first_success", """
SELECT o_custkey AS broadcast, coalesce(min(CASE WHEN o_orderkey % 5 <> 1 THEN o_orderkey END), min(o_orderkey)) AS peer, bool_or(o_orderkey % 5 <> 1) AS ok FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY 1""")
def first_success(spark, sf_dir):
    return broadcast.first_success(_replies(spark, sf_dir))


# --- liability ----------------------------------------------------------------

_SCAN = """
SELECT concat('e', s_suppkey) AS server, 'user' AS scope, s_suppkey AS position,
  CASE WHEN s_suppkey % 10 = 0 THEN 'router' WHEN s_suppkey % 10 = 9 THEN 'folded' ELSE 'wrapped' END AS state,
  CASE WHEN s_suppkey % 10 = 0 THEN concat('click, peer', s_suppkey) WHEN s_suppkey % 10 = 1 THEN 'python3 -m s' WHEN s_suppkey % 10 = 2 THEN 'python3 -m t'
    WHEN s_suppkey % 10 = 3 THEN '/bin/view --x' WHEN s_suppkey % 10 = 4 THEN '' ELSE concat('/srv/run', s_suppkey) END AS wraps,
  CASE WHEN s_suppkey % 10 IN (3, 5) THEN concat('n', s_suppkey) END AS ledger_identity, s_suppkey % 10 IN (3, 5) AS ledger_identity_explicit,
  CASE WHEN s_suppkey % 6 <> 0 THEN s_suppkey % 5 * 100 END AS primer_tokens
FROM supplier"""


def installed(spark, sf_dir):
    return spark.sql(_SCAN.replace("FROM supplier", "FROM {supplier}"), supplier=table(spark, sf_dir, "supplier"))


@query("resolved_labels", f"""
WITH e AS ({_SCAN}), k AS (SELECT count(*) FILTER (WHERE position % 10 IN (1, 2)) AS shared FROM e), v AS (SELECT count(*) AS rows FROM events WHERE event_type = 'view' AND event_id % 17 <> 0 AND event_id % 19 <> 0)
SELECT server, CASE position % 10 WHEN 0 THEN 'click|peer' || position WHEN 1 THEN CASE WHEN shared > 1 THEN '' ELSE 'python3' END WHEN 2 THEN CASE WHEN shared > 1 THEN '' ELSE 'python3' END
    WHEN 3 THEN 'n' || position WHEN 4 THEN '' WHEN 5 THEN 'n' || position ELSE 'run' || position END AS labels,
  CASE WHEN position % 10 IN (1, 2) AND shared > 1 THEN 'ambiguous ledger label' END AS no_label_reason,
  CASE WHEN position % 10 = 3 AND v.rows > 0 THEN 'view' ELSE '' END AS superseded
FROM e, k, v WHERE position % 10 <> 9""")
def resolved_labels(spark, sf_dir):
    known = ledger.by_tool(view(spark, sf_dir, "ledger")).select(F.col("server").alias("label"))
    rows = liability.resolved(installed(spark, sf_dir), known)
    return rows.select("server", F.array_join("labels", "|").alias("labels"), "no_label_reason", F.array_join("superseded_labels", "|").alias("superseded"))


@query("installed_liability")
def installed_liability(spark, sf_dir):
    rows = view(spark, sf_dir, "ledger")
    return liability.liability(installed(spark, sf_dir), ledger.by_tool(rows), ledger.primers(rows)).select(
        "server", "state", "primer_tokens", "primer_source", "blocks", "tokenized", "cadence", "break_even_verdict", "verdict", "verdict_reason")


@query("installed_totals")
def installed_totals(spark, sf_dir):
    rows = view(spark, sf_dir, "ledger")
    own = liability.liability(installed(spark, sf_dir), ledger.by_tool(rows), ledger.primers(rows))
    made = liability.totals(own, ledger.totals(rows))
    return made.withColumns({x: F.size(x) for x in ("idle", "free", "uncertain")})


@query("rule_traffic", f"""
WITH t AS (SELECT server, {_CANON} AS tool, count(*) AS blocks FROM ledger WHERE {_RESULT} GROUP BY ALL),
 l AS (SELECT name, sum(blocks) AS blocks FROM (SELECT server || '.' || tool AS name, blocks FROM t UNION ALL SELECT tool, blocks FROM t) GROUP BY 1)
SELECT r.tool, CAST(l.blocks AS BIGINT) AS live_blocks FROM (SELECT unnest(['t1', 'click.t2', 'view.t3', 'none.t1']) AS tool) r LEFT JOIN l ON l.name = r.tool""", ("ledger",))
def rule_traffic(spark, sf_dir):
    rules = spark.createDataFrame([("t1",), ("click.t2",), ("view.t3",), ("none.t1",)], "tool string")
    return ledger.traffic_of_rules(rules, ledger.by_tool(view(spark, sf_dir, "ledger"))).select("tool", "live_blocks")


@query("writer_rows", """
SELECT 'lib' AS server, lang AS tool, count(*) AS blocks, CAST(sum(length(text)) AS BIGINT) AS raw_chars, CAST(sum(length(text) // 2) AS BIGINT) AS out_chars FROM documents WHERE text IS NOT NULL GROUP BY 2""")
def writer_rows(spark, sf_dir):
    """Ledger rows as the writers make them, rolled up again."""
    text = F.col("text")
    made = ledger.result_row("lib", F.col("doc_id"), F.col("lang"), F.lit("compressed"), text, F.expr("substr(text, 1, length(text) div 2)"), F.lit("v1"))
    rows = table(spark, sf_dir, "documents").select(made.alias("r")).select("r.*")
    return ledger.by_tool(rows).select("server", "tool", "blocks", "raw_chars", "out_chars")


# --- whole sessions -----------------------------------------------------------


def session_rows(spark, sf_dir):
    """A replay of all events: requests, results of every kind, and new sessions now and then."""
    e = F.col("event_id")
    thing = lambda n: F.to_json(F.struct((e % 3).alias("state"), F.lit("a fixed and rather long description of the result; " * 8).alias("about"), (e % 5 + n).alias("n")))
    one, two, text = thing(0), thing(1), F.concat(F.lit("plain words of a result\n" * 20), e.cast("string"))
    blocks = F.when(e % 10 == 3, F.array(one, two)).when(e % 10 == 5, F.array(one, two, text)).when(e % 10 == 7, F.array(text)).otherwise(F.array(one))
    kind = F.when(e % 1000 == 0, "initialize").when(e % 2 == 0, "request").otherwise("response")
    number = F.expr("case when event_id % 2 = 0 then event_id div 2 else (event_id - 1) div 2 end").cast("string")
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 3).cast("string").alias("session"), e.alias("seq"), number.alias("id"), kind.alias("dir"), F.col("event_type").alias("tool"), F.lit("").alias("args"), F.lit("desk").alias("client"),
        F.when(e % 2 == 1, F.to_json(blocks)).alias("blocks"), F.when(e % 10 == 9, one).alias("structured"), F.lit(False).alias("error"))


@query("stream_transform", """
WITH e AS (SELECT event_id, user_id % 3 AS session FROM events), q AS (SELECT event_id + 1 AS seq, session FROM e WHERE event_id % 2 = 0 AND event_id % 1000 <> 0)
SELECT CAST(e.session AS VARCHAR) AS session, e.event_id AS seq,
  CASE WHEN q.seq IS NULL THEN 'untracked' ELSE CASE e.event_id % 10 WHEN 1 THEN 'single' WHEN 3 THEN 'joined' WHEN 5 THEN 'partial' WHEN 7 THEN 'text' ELSE 'mirror' END END AS path
FROM e LEFT JOIN q ON q.seq = e.event_id AND q.session = e.session WHERE e.event_id % 2 = 1""")
def stream_transform(spark, sf_dir):
    return _streamed(spark, session_rows(spark, sf_dir), pipeline.Replacing, "session").select("session", "seq", "path")


@query("transform_fold")
def transform_fold(spark, sf_dir):
    return run.fold(session_rows(spark, sf_dir), pipeline.Replacing, "session")


@query("text_chain")
def text_chain(spark, sf_dir):
    """Turns of a conversation as texts of one session: deltas on the one before."""
    rows = table(spark, sf_dir, "conversations").where("text is not null").select(F.col("conv_id").cast("string").alias("session"), F.lit("talk").alias("tool"), F.col("turn").alias("seq"), F.concat(F.lit("shared head of every turn\n" * 30), F.col("text")).alias("raw"))
    return run.fold(rows, machines.TextChain, "session", "tool")

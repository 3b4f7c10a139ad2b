"""Usage ledger: roll-ups, verdict ladders and joins with other tables.

A ledger row is a result (``event`` null), a retrieve or a primer.  Unknown token
counts are null and never count as zero: token sums take rows where both counts
are known, and the others are counted apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P

RESULT_COLUMNS = ("raw_chars", "out_chars", "raw_tokens", "out_tokens")
# Fixed values ---------------------------------------------------------------
PER_TURN, ONCE, ONCE_FREE, ONCE_UNKNOWN = "per-turn", "once/session", "once/session (unpaid)", "once/session (?)"
EAGER_STATES = ("router", "router-ambiguous")
PAYING_STATES = ("wrapped", "wrapped-unstashed", "router", "router-ambiguous")
KEEP, TUNE, UNWRAP, INSUFFICIENT = "KEEP", "TUNE", "UNWRAP", "INSUFFICIENT"
NO_DATA = ("no ledger label", "ambiguous ledger label", "no token data", "primer unknown")
# ----------------------------------------------------------------------------


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("long")


def results(ledger: DataFrame) -> DataFrame:
    """Result rows, with the canonical tool and whether tokens are known."""
    rows = ledger.where(F.col("event").isNull() & F.col("raw_chars").isNotNull() & F.col("out_chars").isNotNull())
    server = F.coalesce("server", F.lit("unknown"))
    return rows.withColumns({
        "server": server,
        "tool": P.canonical_tool(server, F.coalesce("tool", F.lit("unknown"))),
        "decision": F.coalesce("decision", F.lit("unknown")),
        "known": F.col("raw_tokens").isNotNull() & F.col("out_tokens").isNotNull(),
    })


def since(ledger: DataFrame, ts: int) -> DataFrame:
    """Rows at or after a time; rows without one go."""
    return ledger.where(F.col("ts") >= ts)


def _tokens(name: str) -> Column:
    return _total(F.when(F.col("known"), F.col(name))).alias(name)


def by_tool(ledger: DataFrame) -> DataFrame:
    rows = results(ledger).groupBy("server", "tool").agg(
        F.count(F.lit(1)).alias("blocks"), _count(F.col("known")).alias("tokenized"),
        _count(~F.col("decision").isin(P.PASSTHROUGH, P.UNCHANGED)).alias("encoded"), _count(F.col("decision") == P.DIFF).alias("diffs"),
        _tokens("raw_tokens"), _tokens("out_tokens"), _total(F.col("raw_chars")).alias("raw_chars"), _total(F.col("out_chars")).alias("out_chars"),
    )
    return rows.withColumn("saved_tokens", F.col("raw_tokens") - F.col("out_tokens"))


def totals(ledger: DataFrame) -> DataFrame:
    return results(ledger).agg(
        F.count(F.lit(1)).alias("blocks"), _total(F.col("raw_chars")).alias("raw_chars"), _total(F.col("out_chars")).alias("out_chars"),
        _tokens("raw_tokens"), _tokens("out_tokens"), _count(~F.col("known")).alias("untokenized"), _count(F.col("version").isNull()).alias("unversioned"),
    )


def by_decision(ledger: DataFrame) -> DataFrame:
    return results(ledger).groupBy("decision").agg(F.count(F.lit(1)).alias("blocks"))


def by_diff_reason(ledger: DataFrame) -> DataFrame:
    return results(ledger).where(F.col("diff_reason").isNotNull()).groupBy("diff_reason").agg(F.count(F.lit(1)).alias("blocks"))


def by_version(ledger: DataFrame) -> DataFrame:
    rows = results(ledger).where(F.col("version").isNotNull()).groupBy("version")
    return rows.agg(F.count(F.lit(1)).alias("blocks"), _count(F.col("known")).alias("tokenized"), _tokens("raw_tokens"), _tokens("out_tokens"))


def retrieves(ledger: DataFrame) -> DataFrame:
    server = F.coalesce("server", F.lit("unknown"))
    rows = ledger.where("event = 'retrieve'").select(
        server.alias("server"), P.canonical_tool(server, F.coalesce("tool", F.lit("unknown"))).alias("tool"),
        F.coalesce("path", F.lit("")).alias("path"), F.coalesce("hit", F.lit(False)).alias("hit"), "bytes", "tokens",
    )
    return rows.groupBy("server", "tool", "path").agg(
        F.count(F.lit(1)).alias("calls"), _count(F.col("hit")).alias("hits"), _count(~F.col("hit")).alias("misses"),
        _total(F.col("bytes")).alias("bytes"), _total(F.col("tokens")).alias("tokens"), _count(F.col("tokens").isNull()).alias("untokenized"),
    )


def primers(ledger: DataFrame) -> DataFrame:
    rows = ledger.where("event = 'primer'").select(
        F.coalesce("server", F.lit("unknown")).alias("server"), F.coalesce("cadence", F.lit("unknown")).alias("cadence"),
        F.coalesce("attached", F.lit(True)).alias("attached"), "bytes", "tokens",
    )
    return rows.groupBy("server", "cadence", "attached").agg(
        F.count(F.lit(1)).alias("emissions"), _total(F.col("bytes")).alias("bytes"), _total(F.col("tokens")).alias("tokens"),
        _count(F.col("tokens").isNull()).alias("untokenized"),
    )


def everything(ledger: DataFrame) -> DataFrame:
    """Totals, servers, (server, tool) and decisions in one pass, by grouping sets."""
    rows = results(ledger)
    rows = rows.groupingSets([[], ["server"], ["server", "tool"], ["decision"]], "server", "tool", "decision")
    return rows.agg(F.count(F.lit(1)).alias("blocks"), _tokens("raw_tokens"), _tokens("out_tokens"), F.grouping_id().alias("level"))


# --------------------------------------------------------------------------
# verdicts


def break_even(rows: DataFrame) -> DataFrame:
    """saved_per_block, blocks_to_break_even, break_even_verdict from (primer_tokens, blocks, tokenized, saved)."""
    rate = F.col("saved") / F.col("tokenized")
    primer = F.col("primer_tokens")
    no_label = F.coalesce(F.col("no_label_reason"), F.lit("no ledger label")) if "no_label_reason" in rows.columns else F.lit("no ledger label")
    verdict = (
        F.when(F.col("blocks").isNull(), no_label)
        .when(F.col("blocks") == 0, "never called")
        .when(F.coalesce("tokenized", F.lit(0)) == 0, "no token data")
        .when(primer.isNull(), "primer unknown")
        .when(primer == 0, "no primer")
        .when(rate <= 0, "never")
    )
    rated = F.col("blocks").isNotNull() & (F.col("blocks") != 0) & (F.coalesce("tokenized", F.lit(0)) != 0)
    need = F.when(rated & (primer == 0), F.lit(0.0)).when(rated & (rate > 0), primer / rate)
    return rows.withColumns({"saved_per_block": F.when(rated, rate), "blocks_to_break_even": need, "break_even_verdict": verdict})


def cadence(rows: DataFrame) -> DataFrame:
    """How often an entry pays its primer, from (state, blocks, encoded[, recorded, unpaid])."""
    flag = lambda name: F.coalesce(F.col(name), F.lit(False)) if name in rows.columns else F.lit(False)
    worked = F.coalesce("encoded", "blocks")
    return rows.withColumn(
        "cadence",
        F.when(F.col("state").isin(*EAGER_STATES), PER_TURN).when(flag("unpaid"), ONCE_FREE).when(flag("recorded"), ONCE)
        .when(F.col("blocks").isNull(), ONCE_UNKNOWN).when(worked != 0, ONCE).otherwise(ONCE_FREE),
    )


def recommend(rows: DataFrame) -> DataFrame:
    """verdict, verdict_reason, break_even_coverage from break_even and cadence columns."""
    why, rate, need = F.col("break_even_verdict"), F.col("saved_per_block"), F.col("blocks_to_break_even")
    primer, known = F.col("primer_tokens"), F.col("tokenized")
    pays = (F.col("cadence") == PER_TURN) & (F.coalesce(primer, F.lit(0)) != 0)
    usable = why.isNull() & (F.coalesce(need, F.lit(0.0)) != 0) & known.isNotNull()
    verdict = (
        F.when(why.isin(*NO_DATA), INSUFFICIENT)
        .when(why == "never called", F.when(pays, UNWRAP).otherwise(INSUFFICIENT))
        .when(why == "never", UNWRAP)
        .when(why == "no primer", F.when(rate < 0, UNWRAP).otherwise(KEEP))
        .when(~usable, INSUFFICIENT)
        .when(known >= need, KEEP)
        .otherwise(TUNE)
    )
    reason = (
        F.when((why == "no primer") & (rate < 0), "expanding")
        .when(why.isNotNull(), why)
        .when(~usable, "no token data")
        .when(known >= need, "cleared")
        .otherwise("short of break-even")
    )
    coverage = F.when((why == "never") & (primer != 0), rate * known / primer).when(usable, known / need)
    return rows.withColumns({"verdict": verdict, "verdict_reason": reason, "break_even_coverage": coverage})


def verdict_order(verdict: Column) -> Column:
    """What needs action comes first."""
    return F.when(verdict == UNWRAP, 0).when(verdict == TUNE, 1).when(verdict == INSUFFICIENT, 2).otherwise(3)


def contributors(tools: DataFrame) -> DataFrame:
    """Evidence per label under an entry, never a verdict of its own."""
    rows = tools.groupBy(F.col("server").alias("label")).agg(F.sum("blocks").alias("blocks"), F.sum("tokenized").alias("tokenized_blocks"), F.sum("saved_tokens").alias("saved_tokens"))
    return rows.withColumn("saved_per_block", F.try_divide(F.col("saved_tokens"), F.col("tokenized_blocks")))


def liability(entries: DataFrame, labels: DataFrame, tools: DataFrame, sent: DataFrame) -> DataFrame:
    """Installed entries against their ledger traffic.

    ``entries``: (entry, state, primer_tokens); ``labels``: (entry, label) pairs, several
    labels for a router; a label claimed by two entries is ambiguous and counts for
    neither.  ``sent``: primers().  The recorded mean primer replaces the estimate.
    """
    shared = labels.groupBy("label").agg(F.count_distinct("entry").alias("owners"))
    owned = labels.join(shared, "label")
    traffic = tools.groupBy(F.col("server").alias("label")).agg(F.sum("blocks").alias("blocks"), F.sum("tokenized").alias("tokenized"), F.sum("encoded").alias("encoded"), F.sum("saved_tokens").alias("saved"))
    primed = sent.groupBy(F.col("server").alias("label")).agg(
        F.sum(F.when(F.col("attached"), F.col("tokens"))).alias("primer_sum"), F.sum(F.when(F.col("attached"), F.col("emissions") - F.col("untokenized"))).alias("primer_n"),
        F.bool_or("attached").alias("recorded"), F.bool_and(~F.col("attached")).alias("unpaid"),
    )
    clear = owned.where("owners = 1").join(traffic, "label", "left").join(primed, "label", "left")
    pooled = clear.groupBy("entry").agg(
        *(F.sum(x).alias(x) for x in ("blocks", "tokenized", "encoded", "saved")), F.sum("primer_sum").alias("primer_sum"), F.sum("primer_n").alias("primer_n"),
        F.bool_or("recorded").alias("recorded"), F.bool_and("unpaid").alias("unpaid"),
    )
    unclear = owned.where("owners > 1").select("entry", F.lit("ambiguous ledger label").alias("no_label_reason")).distinct()
    rows = entries.where(F.col("state").isin(*PAYING_STATES)).join(pooled, "entry", "left").join(unclear, "entry", "left")
    mean = F.try_divide(F.col("primer_sum"), F.col("primer_n"))
    primer = F.when(F.coalesce("unpaid", F.lit(False)), F.lit(0.0)).otherwise(F.coalesce(F.when(mean > 0, mean), F.col("primer_tokens").cast("double")))
    rows = rows.withColumn("primer_source", F.when(F.coalesce("unpaid", F.lit(False)) | (mean > 0), "recorded").otherwise("estimated"))
    return recommend(cadence(break_even(rows.withColumn("primer_tokens", primer)))).drop("primer_sum", "primer_n")


def blind_spots(tools: DataFrame, corpus: DataFrame) -> DataFrame:
    """Ledger tools that no captured payload covers.

    ``corpus``: (server, tool).  A qualified match covers; a bare name covers only on the
    side that lacks a server.
    """
    ids = corpus.select(F.nullif("server", F.lit("")).alias("cs"), F.col("tool").alias("ct")).distinct()
    server = F.nullif(F.nullif(F.col("server"), F.lit("unknown")), F.lit(""))
    rows = tools.withColumn("own", server)
    same = rows.join(ids.where("cs is not null"), (F.col("own") == F.col("cs")) & (F.col("tool") == F.col("ct")), "left_anti")
    nameless = ids.where("cs is null").select(F.col("ct").alias("tool")).distinct()
    left = same.join(nameless, "tool", "left_anti")
    bare = ids.select(F.col("ct").alias("tool")).distinct().withColumn("seen", F.lit(True))
    return left.join(bare, "tool", "left").where(~(F.col("own").isNull() & F.coalesce("seen", F.lit(False)))).drop("own", "seen")


def traffic_of_rules(rules: DataFrame, tools: DataFrame) -> DataFrame:
    """Tuned tools against live traffic, found under the qualified or the bare name."""
    keys = F.array_distinct(F.array(F.concat_ws(".", "server", "tool"), F.col("tool")))
    live = tools.withColumn("name", F.explode(keys)).groupBy("name").agg(F.sum("blocks").alias("live_blocks"), F.sum("saved_tokens").alias("live_saved"))
    return rules.join(live, rules["tool"] == live["name"], "left").drop("name")


def trend(runs: DataFrame) -> DataFrame:
    """Change of saved_pct against the run just before; null beside a null."""
    before = F.lag("saved_pct").over(Window.partitionBy("label").orderBy("ts"))
    return runs.withColumn("delta_points", F.col("saved_pct") - before)


# --------------------------------------------------------------------------
# rows as writers make them


def result_row(server: str, ts: Column, tool: Column, decision: Column, raw: Column, out: Column, version: Column, diff_reason: Column | None = None, tokens=P.token_count) -> Column:
    """A ledger row of one result, as a struct; sizes only, no content."""
    none = F.lit(None).cast("string")
    return F.struct(
        ts.alias("ts"), version.alias("version"), F.lit(server).alias("server"), tool.alias("tool"), decision.alias("decision"), (none if diff_reason is None else diff_reason).alias("diff_reason"),
        F.length(raw).cast("long").alias("raw_chars"), F.length(out).cast("long").alias("out_chars"), tokens(raw).cast("long").alias("raw_tokens"), tokens(out).cast("long").alias("out_tokens"), none.alias("event"),
    )


def retrieve_row(server: str, ts: Column, tool: Column, path: Column, value: Column, tokens=P.token_count) -> Column:
    """A row of one look-up of a dropped value; a null value is a miss."""
    size = F.when(value.isNotNull(), F.octet_length(value)).otherwise(0).cast("long")
    held = F.when(value.isNotNull(), tokens(value)).otherwise(0).cast("long")
    return F.struct(ts.alias("ts"), F.lit(server).alias("server"), tool.alias("tool"), F.lit("retrieve").alias("event"), path.alias("path"), value.isNotNull().alias("hit"), size.alias("bytes"), held.alias("tokens"))


def primer_row(server: str, ts: Column, text: Column, attached: Column, cadence: str = ONCE, tokens=P.token_count) -> Column:
    """A row of one primer that went out, or was held back and so has no size."""
    size = F.when(attached, F.octet_length(text)).otherwise(0).cast("long")
    return F.struct(ts.alias("ts"), F.lit(server).alias("server"), F.lit("primer").alias("event"), F.lit(cadence).alias("cadence"), attached.alias("attached"), size.alias("bytes"), F.when(attached, tokens(text)).otherwise(0).cast("long").alias("tokens"))

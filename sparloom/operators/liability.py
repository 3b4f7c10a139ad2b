"""What installed entries owe for their primers, against what the ledger says they saved.

Entries are rows of a scan: (server, scope, state, wraps, policy, ledger_identity,
ledger_identity_explicit, primer_tokens), ``position`` giving their order; the first entry
of a name counts.  An entry reads the ledger under its labels: a router under its peers', a
wrapped one under its recorded name or, failing that, the name of its command.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from . import ledger as L

# Fixed values
ROUTERS, NO_PEERS, AMBIGUOUS = ("router", "router-ambiguous"), "(no peers)", "ambiguous ledger label"


def server_label(command: Column) -> Column:
    """The host of a URL or the base name of a command, from its first word."""
    target = F.element_at(F.split(F.trim(command), r"\s+"), 1)
    host = F.regexp_extract(target, r"^[^:/]*://([^/?#]*)", 1)
    base = F.element_at(F.split(F.regexp_replace(target, "/+$", ""), "/"), -1)
    return F.when(F.coalesce(target, F.lit("")) == "", "unknown").when(F.contains(target, F.lit("://")), F.when(host != "", host).otherwise(target)).otherwise(F.when(base != "", base).otherwise(target))


def _peers(wraps: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(wraps, F.lit("")), ","), lambda p: F.trim(p)), lambda p: p != "")


def first_by_name(entries: DataFrame) -> DataFrame:
    """Paying entries, each name once: the same name in two scopes is one server."""
    paying = entries.where(F.col("state").isin(*L.PAYING_STATES) & (F.coalesce("server", F.lit("")) != ""))
    place = F.row_number().over(Window.partitionBy("server").orderBy("position"))
    return paying.withColumn("place", place).where("place = 1").drop("place")


def resolved(entries: DataFrame, known: DataFrame) -> DataFrame:
    """Entries with their labels, why there are none, and labels they have most likely left behind.

    ``known``: labels with ledger rows (label).  A guessed launcher name that several
    entries share is ambiguous.  A left label is the command's name of an entry that has since been
    named, with rows, no launcher's and none that another entry still answers to.
    """
    rows = first_by_name(entries)
    router = F.col("state").isin(*ROUTERS)
    guess = F.when(F.coalesce("wraps", F.lit("")) != "", server_label(F.col("wraps"))).otherwise("")
    ident = F.coalesce("ledger_identity", F.lit(""))
    named = (ident != "") & F.coalesce("ledger_identity_explicit", F.lit(False))
    rows = rows.withColumns({"is_router": router, "command": guess, "guess": F.when(router | named, F.lit("")).when(ident != "", ident).otherwise(guess)})
    shared = rows.where((F.col("guess") != "") & P.is_launcher(F.col("guess"))).groupBy("guess").agg(F.count(F.lit(1)).alias("sharers")).where("sharers > 1")
    rows = rows.join(shared, "guess", "left").withColumn("unclear", F.col("sharers").isNotNull())
    peers = F.when(F.coalesce("wraps", F.lit("")) == NO_PEERS, F.array().cast("array<string>")).otherwise(_peers(F.col("wraps")))
    own = F.when(named, F.array(ident)).when((F.col("guess") == "") | F.col("unclear"), F.array().cast("array<string>")).otherwise(F.array("guess"))
    rows = rows.withColumns({"labels": F.when(F.col("is_router"), peers).otherwise(own), "peerless": F.col("is_router") & (F.coalesce("wraps", F.lit("")) == NO_PEERS), "no_label_reason": F.when(F.col("unclear") & ~F.col("is_router"), AMBIGUOUS)})
    live = live_labels(entries).select(F.col("label").alias("command"), F.lit(True).alias("is_live"))
    written = known.select(F.col("label").alias("command"), F.lit(True).alias("written")).distinct()
    rows = rows.join(live, "command", "left").join(written, "command", "left")
    left = (F.col("command") != "") & ~F.array_contains("labels", F.col("command")) & ~P.is_launcher(F.col("command")) & F.col("is_live").isNull() & F.col("written").isNotNull() & ~F.col("is_router")
    return rows.withColumn("superseded_labels", F.when(left, F.array("command")).otherwise(F.array().cast("array<string>"))).drop("guess", "command", "sharers", "unclear", "is_live", "written")


def live_labels(entries: DataFrame) -> DataFrame:
    """(label): all that some installed entry answers to now."""
    router = F.col("state").isin(*ROUTERS)
    wraps, ident = F.coalesce("wraps", F.lit("")), F.coalesce("ledger_identity", F.lit(""))
    own = F.when(router, _peers(F.col("wraps"))).when(ident != "", F.array(ident)).when(wraps != "", F.array(server_label(wraps))).otherwise(F.array().cast("array<string>"))
    folded = F.when(F.startswith(F.coalesce("state", F.lit("")), F.lit("folded")) & F.col("server").isNotNull(), F.array("server")).otherwise(F.array().cast("array<string>"))
    return entries.select(F.explode(F.concat(own, folded)).alias("label")).distinct()


def _primed(sent: DataFrame) -> DataFrame:
    """By label: tokens and emissions that can be sized, whether it attached, whether it surely did not."""
    once = sent.where((F.col("cadence") == L.ONCE) & (F.coalesce("server", F.lit("")) != ""))
    attached = F.coalesce("attached", F.lit(True))
    sized = attached & (F.col("emissions") - F.coalesce("untokenized", F.lit(0)) > 0)
    empty = ~attached & (F.coalesce("tokens", F.lit(0)) == 0) & (F.coalesce("bytes", F.lit(0)) == 0)
    return once.groupBy(F.col("server").alias("label")).agg(
        F.sum(F.when(sized, F.coalesce("tokens", F.lit(0))).otherwise(0)).alias("rec_tokens"), F.sum(F.when(sized, F.col("emissions") - F.coalesce("untokenized", F.lit(0))).otherwise(0)).alias("rec_emissions"),
        F.bool_or(attached).alias("attached"), F.bool_or(empty).alias("suppressed"),
    )


def liability(entries: DataFrame, tools: DataFrame, sent: DataFrame) -> DataFrame:
    """One row per paying entry: primer, labels, blocks, cadence, break-even and verdict.

    ``tools``: ledger.by_tool; ``sent``: ledger.primers.  A recorded mean primer replaces
    the estimate; a label that only ever suppressed its primer owes none.
    """
    traffic = tools.groupBy(F.col("server").alias("label")).agg(
        F.sum("blocks").alias("blocks"), F.sum("tokenized").alias("tokenized"), F.sum("saved_tokens").alias("saved"), F.when(F.count("encoded") == F.count(F.lit(1)), F.sum("encoded")).alias("encoded"))
    rows = resolved(entries, traffic)
    pairs = rows.select("server", F.explode("labels").alias("label")).distinct().join(traffic, "label", "left").join(_primed(sent), "label", "left")
    zero = lambda name: F.sum(F.coalesce(name, F.lit(0))).alias(name)
    pooled = pairs.groupBy("server").agg(
        *map(zero, ("blocks", "tokenized", "saved", "rec_tokens", "rec_emissions")),
        F.when(F.count("encoded") == F.count(F.lit(1)), F.sum("encoded")).alias("encoded"),
        F.bool_or(F.coalesce("attached", F.lit(False))).alias("any_attached"), F.bool_and(F.coalesce("suppressed", F.lit(False))).alias("all_suppressed"),
        F.array_sort(F.collect_list(F.struct("label", F.coalesce("blocks", F.lit(0)).alias("blocks"), F.coalesce("tokenized", F.lit(0)).alias("tokenized"), F.coalesce("saved", F.lit(0)).alias("saved")))).alias("contributors"),
    )
    rows = rows.join(pooled, "server", "left")
    none = F.size("labels") == 0
    for name in ("blocks", "tokenized", "saved", "encoded"):
        rows = rows.withColumn(name, F.when(F.col("peerless"), F.lit(0)).when(none, F.lit(None)).otherwise(F.col(name)).cast("long"))
    recorded = (F.coalesce("rec_emissions", F.lit(0)) > 0) & (F.coalesce("rec_tokens", F.lit(0)) > 0) & ~F.col("is_router")
    unpaid = ~recorded & ~F.col("is_router") & ~none & ~F.coalesce("any_attached", F.lit(False)) & F.coalesce("all_suppressed", F.lit(False))
    rows = rows.withColumns({"recorded": recorded, "unpaid": unpaid})
    tokens = F.when(F.col("unpaid"), F.lit(0)).when(F.col("recorded"), F.bround(F.col("rec_tokens") / F.col("rec_emissions"))).otherwise(F.col("primer_tokens"))
    rows = rows.withColumns({"primer_tokens": tokens.cast("long"), "primer_source": F.when(F.col("unpaid") | F.col("recorded"), "recorded").otherwise("estimated")})
    return L.recommend(L.cadence(L.break_even(rows))).drop("rec_tokens", "rec_emissions", "any_attached", "all_suppressed", "is_router", "peerless", "recorded", "unpaid")


def totals(rows: DataFrame, total: DataFrame) -> DataFrame:
    """Sums by cadence, entries that could not be sized, idle, free and unclear ones, and how far the savings go.

    ``total``: one row of (raw_tokens, out_tokens).
    """
    tokens = F.coalesce("primer_tokens", F.lit(0))
    names = lambda ok: F.array_sort(F.collect_list(F.when(ok, F.col("server"))))
    made = rows.agg(
        F.coalesce(F.sum(F.when(F.col("cadence") == L.PER_TURN, tokens)), F.lit(0)).alias("per_turn_tokens"), F.coalesce(F.sum(F.when(F.col("cadence") == L.ONCE, tokens)), F.lit(0)).alias("session_once_tokens"),
        F.count_if(F.col("primer_tokens").isNull()).alias("unresolved"), names((F.col("cadence") == L.PER_TURN) & (F.col("blocks") == 0) & (tokens > 0)).alias("idle"),
        names((F.col("cadence") == L.ONCE_FREE) & ((tokens > 0) | (F.col("primer_source") == "recorded"))).alias("free"), names(F.col("cadence") == L.ONCE_UNKNOWN).alias("uncertain"),
    )
    saved = total.agg(F.sum(F.coalesce("raw_tokens", F.lit(0)) - F.coalesce("out_tokens", F.lit(0))).alias("saved_tokens"))
    made = made.join(saved)  # one row beside one row
    return made.withColumns({"turns_covered": F.try_divide("saved_tokens", "per_turn_tokens"), "session_covered": F.try_divide("saved_tokens", "session_once_tokens")})

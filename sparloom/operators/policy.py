"""Policy: rule selection as a glob join, tier decisions, coverage of rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as P

# Fixed values
THRESHOLD = 5.0
BASE_TIERS = ("minify", "tabularize")
KNOWN_KEYS = {"version", "rules", "defaults", "diff", "join_blocks", "diff_keyframe_interval", "never_lossy_servers"}


class PolicyError(ValueError):
    """A policy that may not be used."""


def load(policy: dict) -> dict:
    """Strict check of a policy: version 1, no unknown keys but those with a leading underscore, real booleans."""
    unknown = [k for k in policy if k not in KNOWN_KEYS and not k.startswith("_")]
    if unknown:
        raise PolicyError(f"unknown keys: {', '.join(sorted(unknown))}")
    if policy.get("version") != 1:
        raise PolicyError("version must be 1")
    for key in ("diff", "join_blocks"):
        if key in policy and not isinstance(policy[key], bool):
            raise PolicyError(f"{key} must be true or false")
    for n, rule in enumerate(policy.get("rules", [])):
        if not isinstance(rule.get("tool"), str) or not rule["tool"]:
            raise PolicyError(f"rule {n} needs a tool glob")
        if "capture" in rule and not isinstance(rule["capture"], bool):
            raise PolicyError(f"rule {n}: capture must be true or false")
    return policy


def rules_table(spark: SparkSession, policy: dict) -> DataFrame:
    """(ord, glob, pattern, tiers): as many rows as the policy has rules."""
    rows = [(i, r["tool"], P.glob_to_regex(r["tool"]), list(r.get("tiers", BASE_TIERS))) for i, r in enumerate(load(policy).get("rules", []))]
    return spark.createDataFrame(rows, "ord int, glob string, pattern string, tiers array<string>")


def candidates(tool: Column, server: Column) -> Column:
    """Names a rule is tried on, in order: server-qualified, as given, without a peer's prefix."""
    cut = F.instr(tool, P.PEER_SEPARATOR)
    bare = F.when(cut > 0, F.substr(tool, cut + len(P.PEER_SEPARATOR))).otherwise(tool)
    named = F.coalesce(server, F.lit("")) != ""
    own = F.when(named & ~F.startswith(bare, F.concat(server, F.lit("."))), F.concat_ws(".", server, bare))
    return F.array_distinct(F.array_compact(F.array(own, tool, bare)))


def select_rules(payloads: DataFrame, rules: DataFrame) -> DataFrame:
    """payloads plus (ord, glob, tiers) of the first rule: a name is tried on all rules before the next name.

    Rules are configuration and few, so names are matched per distinct (server, tool).
    """
    keys = payloads.select("server", "tool").distinct()
    names = keys.select("server", "tool", F.posexplode(candidates(F.col("tool"), F.col("server"))).alias("pos", "name"))
    met = names.join(F.broadcast(rules), F.expr("name rlike pattern"))
    best = met.groupBy("server", "tool").agg(F.min_by(F.struct("ord", "glob", "tiers"), F.struct("pos", "ord")).alias("rule"))
    chosen = keys.join(best.withColumnsRenamed({"server": "s", "tool": "t"}), F.col("server").eqNullSafe(F.col("s")) & (F.col("tool") == F.col("t")), "left").drop("s", "t")
    chosen = chosen.withColumnsRenamed({"server": "s", "tool": "t"})
    joined = payloads.join(chosen, payloads["server"].eqNullSafe(F.col("s")) & (payloads["tool"] == F.col("t"))).drop("s", "t")
    return joined.select(*payloads.columns, F.col("rule.ord").alias("ord"), F.coalesce("rule.glob", F.lit("*")).alias("glob"), "rule.tiers")


def dead_rules(globs: list[str]) -> list[int]:
    """Rules that an earlier one always forestalls: an earlier '*', or an earlier literal prefix with a last '*'."""
    dead = []
    for i, glob in enumerate(globs):
        for before in globs[:i]:
            head = before[:-1]
            literal = before.endswith("*") and not any(ch in head for ch in "*?[")
            if before == glob or literal and glob.startswith(head):
                dead.append(i)
                break
    return dead


def merge(existing: list[dict], generated: list[dict]) -> list[dict]:
    """Generated rules replace those of the same glob; a new one goes before the first rule that would forestall it."""
    made = {r["tool"]: r for r in generated}
    out = [made.pop(r["tool"]) if r["tool"] in made else r for r in existing]
    for rule in made.values():
        at = next((i for i, r in enumerate(out) if dead_rules([r["tool"], rule["tool"]]) == [1]), len(out))
        out.insert(at, rule)
    return out


def decide_tiers(measured: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Tiers of each tool from its summed measurements.

    ``measured``: tool, gate_fail, emb_fail, raw_tok, total, dictionary, embedded and
    rebased_total (the total without the embedded tier).
    """
    total = F.when(F.col("emb_fail") > 0, F.col("rebased_total")).otherwise(F.col("total"))
    pct = lambda c: F.coalesce(F.try_divide(c * 100.0, F.col("raw_tok")), F.lit(0.0))
    rows = measured.withColumns({"total_pct": pct(total), "dict_pct": pct(F.col("dictionary")), "emb_pct": pct(F.when(F.col("emb_fail") > 0, 0).otherwise(F.col("embedded")))})
    off = (F.col("gate_fail") > 0) | (F.col("total_pct") < threshold)
    more = F.array_compact(F.array(F.when(F.col("dict_pct") >= threshold, "dictionary"), F.when((F.col("emb_fail") == 0) & (F.col("emb_pct") >= threshold), "embedded")))
    tiers = F.when(off, F.array().cast("array<string>")).otherwise(F.concat(F.array(*map(F.lit, BASE_TIERS)), more))
    reason = F.when(F.col("gate_fail") > 0, "failed round-trip").when(F.col("total_pct") < threshold, "below threshold").otherwise("saved")
    return rows.withColumns({"tiers": tiers, "reason": reason}).orderBy(F.desc("total_pct"), "tool")

"""Probes of how much a dictionary or a delta could save, on shredded cells and tokens.

``cells`` has (payload, key, value): one row per cell, the value as its string.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P

# Fixed values of the verdicts.
BUILD_OVERLAP, CLOSE_INCREMENT, BUILD_INCREMENT, FEW = 0.15, 0.03, 0.10, 30


def value_redundancy(cells: DataFrame, *keys: str, tokens=P.token_count) -> DataFrame:
    """Repeated-value mass per group: cells, distinct values, token sums, what a legend could save."""
    counts = cells.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n")).withColumn("t", tokens(F.col("value")))
    more = F.col("n") - 1
    rows = counts.groupBy(*keys).agg(
        F.sum("n").alias("cells"), F.count(F.lit(1)).alias("distinct_values"), F.sum(F.col("t") * F.col("n")).alias("total_value_tokens"),
        F.sum(F.col("t") * more).alias("redundant_value_tokens"), F.sum(F.greatest(F.lit(0), F.col("t") - 1) * more).alias("est_dict_saving_tokens"),
    )
    return rows.withColumn("redundancy_ratio", F.try_divide(F.col("redundant_value_tokens"), F.col("total_value_tokens")))


def field_profiles(cells: DataFrame, tokens=P.token_count) -> DataFrame:
    """Presence, cardinality, size and token share of each (payload, key)."""
    rows = cells.withColumn("t", tokens(F.col("value"))).groupBy("payload", "key").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("value").alias("distinct_values"), F.sum("t").alias("tokens"), F.max("t").alias("max_tok"),
    )
    share = F.col("tokens") / F.sum("tokens").over(Window.partitionBy("payload"))
    return rows.withColumns({"uniq_ratio": F.col("distinct_values") / F.col("n"), "mean_tok": F.col("tokens") / F.col("n"), "tok_share": share})


def drop_candidates(profiles: DataFrame) -> DataFrame:
    """Fields worth a handle: large, near unique, a tenth of the tokens, not an identity; prose first."""
    rows = profiles.groupBy("key").agg(*(F.avg(x).alias(x) for x in ("mean_tok", "uniq_ratio", "tok_share")), F.count(F.lit(1)).alias("payloads"))
    rows = rows.withColumn("role", P.field_role(F.col("key"))).where("mean_tok >= 50 and uniq_ratio >= 0.9 and tok_share >= 0.10 and role <> 'identity'")
    return rows.orderBy(F.when(F.col("role") == "prose", 0).otherwise(1), F.desc("tok_share"), "key")


def token_counts(payloads: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, token, n)."""
    return payloads.select(F.col(id_col).alias("id"), F.explode(P.token_stream(F.col(text_col))).alias("token")).groupBy("id", "token").agg(F.count(F.lit(1)).alias("n"))


def token_idf(counts: DataFrame, payloads: Column | int) -> DataFrame:
    """(token, df, idf = ln(N / df)), of (id, token) rows or of (token, df)."""
    rows = counts if "df" in counts.columns else counts.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    return rows.withColumn("idf", F.log(F.lit(payloads) / F.col("df")))


def token_dfs(payloads: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(token, df), counted where the texts are, so no (id, token) rows are shuffled."""
    tokens = _whole(payloads, id_col, text_col).select(F.explode(F.array_distinct(P.token_stream(F.col("text")))).alias("token"))
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def _whole(payloads: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text): all texts of an id as one (a line end parts tokens)."""
    return payloads.groupBy(F.col(id_col).alias("id")).agg(F.array_join(F.collect_list(text_col), "\n").alias("text"))


def pair_overlap(pairs: DataFrame, payloads: DataFrame, id_col: str, text_col: str, idf: DataFrame | None = None, unseen: Column | None = None) -> DataFrame:
    """Multiset overlap of (prev, curr) pairs of ids: tokens, shared, ratio[, content ratio].

    The two texts of a pair meet in one row and are compared there, so texts are shuffled and not their
    tokens.  With ``idf`` (token, idf), the distinct tokens of ``curr`` go on, and meet their weights;
    ``unseen`` is the weight of tokens that it leaves out.
    """
    text = _whole(payloads, id_col, text_col)
    both = pairs.join(text.select(F.col("id").alias("curr"), F.col("text").alias("ct")), "curr").join(text.select(F.col("id").alias("prev"), F.col("text").alias("pt")), "prev", "left")
    if idf is None:
        rows = both.select("prev", "curr", _met(P.token_stream(F.col("ct")), P.token_stream(F.col("pt"))).alias("m")).select("prev", "curr", "m.curr_tokens", "m.shared_tokens")
        rows = rows.groupBy("prev", "curr").agg(F.sum("curr_tokens").alias("curr_tokens"), F.sum("shared_tokens").alias("shared_tokens"))
        return rows.where("curr_tokens > 0").withColumn("overlap_ratio", F.col("shared_tokens") / F.col("curr_tokens"))
    met = both.select("prev", "curr", F.explode(_met_each(P.token_stream(F.col("ct")), P.token_stream(F.col("pt")))).alias("m")).select("prev", "curr", "m.*")
    met = met.join(idf.select("token", "idf"), "token", "inner" if unseen is None else "left")
    met = met if unseen is None else met.withColumn("idf", F.coalesce("idf", unseen))
    rows = met.groupBy("prev", "curr").agg(
        F.sum("cn").alias("curr_tokens"), F.sum("shared").alias("shared_tokens"), F.sum(F.col("shared") * F.col("idf")).alias("shared_weight"), F.sum(F.col("cn") * F.col("idf")).alias("curr_weight"))
    rows = rows.withColumn("overlap_ratio", F.col("shared_tokens") / F.col("curr_tokens"))
    return rows.withColumn("content_overlap_ratio", F.try_divide(F.col("shared_weight"), F.col("curr_weight")))


def _shared(curr, prev) -> list[tuple[str, int, int]]:
    """(token, times in curr, of them met in prev)."""
    held = Counter(prev) if prev is not None else Counter()
    return [(token, n, min(n, held[token])) for token, n in Counter(curr).items()] if curr is not None else []


def _met(curr: Column, prev: Column) -> Column:
    @F.pandas_udf("curr_tokens long, shared_tokens long")
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        found = [_shared(x, y) for x, y in zip(a, b)]
        return pd.DataFrame({"curr_tokens": [sum(n for _, n, _ in f) for f in found], "shared_tokens": [sum(m for *_, m in f) for f in found]})

    return run(curr, prev)


def _met_each(curr: Column, prev: Column) -> Column:
    @F.pandas_udf("array<struct<token:string,cn:long,shared:long>>")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([[{"token": t, "cn": n, "shared": m} for t, n, m in _shared(x, y)] for x, y in zip(a, b)], dtype=object)

    return run(curr, prev)


def cross_server_redundancy(cells: DataFrame) -> DataFrame:
    """Saving of one shared legend against one legend per server, in one row.  ``cells`` has server, value."""
    by = cells.groupBy("server", "value").agg(F.count(F.lit(1)).alias("n")).withColumn("t", F.greatest(F.lit(0), P.token_count(F.col("value")) - 1))
    values = by.groupBy("value", "t").agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("within"))
    rows = values.agg(
        F.sum(F.col("t") * F.col("within")).alias("per_peer_saving_tokens"), F.sum(F.col("t") * (F.col("n") - 1)).alias("pooled_saving_tokens"),
        F.sum(P.token_count(F.col("value")) * F.col("n")).alias("pooled_total_value_tokens"),
    )
    more = F.col("pooled_saving_tokens") - F.col("per_peer_saving_tokens")
    return rows.withColumns({
        "cross_server_increment_tokens": more, "increment_frac_of_corpus": F.try_divide(more, F.col("pooled_total_value_tokens")),
        "increment_frac_over_per_peer": F.try_divide(more, F.col("per_peer_saving_tokens")),
    })


def server_pairs(payloads: DataFrame, cap: int = 20) -> DataFrame:
    """Payloads of two servers side by side: (a, b, prev, curr), by rank of their hash up to ``cap``."""
    order = Window.partitionBy("server").orderBy("sha", "id")
    ranked = payloads.where("server is not null").withColumn("place", F.row_number().over(order)).where(F.col("place") <= cap)
    left = ranked.select(F.col("server").alias("a"), F.col("id").alias("prev"), "place")
    right = ranked.select(F.col("server").alias("b"), F.col("id").alias("curr"), "place")
    return left.join(right, (left["place"] == right["place"]) & (left["a"] < right["b"])).select("a", "b", "prev", "curr")


def upper_median(value: str) -> Column:
    """The upper of the two middle values: exact for a bounded group (capped pairs)."""
    held = F.array_sort(F.collect_list(value))
    return F.element_at(held, (F.floor(F.size(held) / 2) + 1).cast("int"))


def upper_median_of(rows: DataFrame, value: str, *keys: str) -> DataFrame:
    """The same for groups of any size, by rank and without gathering."""
    order = Window.partitionBy(*keys).orderBy(value)
    over = Window.partitionBy(*keys)
    ranked = rows.where(F.col(value).isNotNull()).withColumns({"place": F.row_number().over(order), "many": F.count(F.lit(1)).over(over)})
    return ranked.where(F.col("place") == F.floor(F.col("many") / 2) + 1).select(*keys, F.col(value).alias("upper_median"))


def overlap_verdict(median: Column) -> Column:
    return F.when(median.isNull(), "inconclusive").when(median >= BUILD_OVERLAP, "build").otherwise("skip")


def increment_verdict(increment: Column, lists: Column, tokens: Column) -> Column:
    return (
        F.when(F.coalesce(tokens, F.lit(0)) == 0, "inconclusive").when(lists < FEW, "thin")
        .when(increment < CLOSE_INCREMENT, "close").when(increment >= BUILD_INCREMENT, "build").otherwise("marginal")
    )


def line_dictionary(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Lines that repeat within a text and what an alias per line could save, by the counter."""
    lines = texts.select(F.col(id_col).alias("id"), F.explode(F.split(F.col(text_col), "\n")).alias("line")).where("length(line) > 0")
    counts = lines.groupBy("id", "line").agg(F.count(F.lit(1)).alias("n")).withColumn("t", P.token_count(F.col("line")))
    gain = F.col("n") * F.col("t") - (F.col("n") + 1 + F.col("t"))
    return counts.where((F.col("n") > 1) & (gain > 0)).groupBy("id").agg(F.count(F.lit(1)).alias("aliases"), F.sum(gain).alias("saved_tokens"))

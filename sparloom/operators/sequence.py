"""Ordered operators: pairs, islands, chain windows, capped round-robin, naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pairs(rows: DataFrame, by: str, *order: str, value: str = "raw") -> DataFrame:
    """Each row with the value just before it in its group; the first has none and goes."""
    before = F.lag(value).over(Window.partitionBy(by).orderBy(*order))
    return rows.withColumn("prev", before).where("prev is not null")


def islands(rows: DataFrame, by: str, *order: str, linked: Column) -> DataFrame:
    """Numbers the maximal runs in which every row is linked to the one before."""
    over = Window.partitionBy(by).orderBy(*order)
    return rows.withColumn("island", F.sum(F.when(linked, 0).otherwise(1)).over(over))


def chain_windows(runs: DataFrame, depth: int, *keys: str, order: str, value: str) -> DataFrame:
    """Windows of depth + 1 values that start at 0, depth, 2 depth ... within a run and fit in it."""
    over = Window.partitionBy(*keys).orderBy(order)
    frame = over.rowsBetween(0, depth)
    placed = runs.withColumns({"place": F.row_number().over(over) - 1, "window_values": F.collect_list(value).over(frame)})
    return placed.where((F.col("place") % depth == 0) & (F.size("window_values") == depth + 1)).select(*keys, "place", "window_values")


def round_robin(rows: DataFrame, cap: int, tool: str, *order: str) -> DataFrame:
    """Up to ``cap`` rows, one of each tool a pass."""
    turn = F.row_number().over(Window.partitionBy(tool).orderBy(*order))
    # no tool can have more than ``cap`` turns in the result, so its rows beyond go before the shuffle
    return rows.withColumn("turn_no", turn).where(F.col("turn_no") <= cap).orderBy("turn_no", tool).limit(cap)


def expose_names(tools: DataFrame, most: int = 10) -> DataFrame:
    """(peer, name) with an exposed name: names that two peers share are qualified by their peer,
    and once more while a qualified name meets another one (at most ``most`` rounds)."""
    rows = tools.select("peer", "name", F.col("name").alias("exposed")).distinct()
    for _ in range(most):
        owners = F.count(F.lit(1)).over(Window.partitionBy("exposed"))
        rows = rows.withColumn("owners", owners).withColumn("next", F.when((F.col("owners") > 1), F.concat_ws("__", "peer", "exposed")).otherwise(F.col("exposed")))
        if rows.where("next <> exposed").limit(1).count() == 0:
            break
        rows = rows.select("peer", "name", F.col("next").alias("exposed"))
    return rows.select("peer", "name", "exposed")


def modal_turns(runs: DataFrame) -> DataFrame:
    """Runs of the commonest number of turns of each arm (the smaller of two)."""
    counts = runs.groupBy("arm", "turns").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("arm").agg(F.max_by("turns", F.struct("n", -F.col("turns"))).alias("turns"))
    return runs.join(best, ["arm", "turns"])

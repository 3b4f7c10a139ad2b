"""Deltas between two keyed snapshots, as joins."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def row_diff(prev: DataFrame, curr: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """(key, op, old, new): op is del, new, set or same; old and new are structs of the other columns."""
    rest = [c for c in prev.columns if c != key]
    a = prev.select(key, F.struct(*rest).alias("old"), F.lit(True).alias("was"))
    b = curr.select(key, F.struct(*rest).alias("new"), F.lit(True).alias("is"))
    both = a.join(b, key, "full_outer")
    op = F.when(F.col("is").isNull(), "del").when(F.col("was").isNull(), "new").when(~F.col("old").eqNullSafe(F.col("new")), "set").otherwise("same")
    return both.select(key, op.alias("op"), "old", "new")


def row_apply(prev: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """The later snapshot from the earlier one and its delta."""
    rest = [c for c in prev.columns if c != key]
    gone = delta.where("op = 'del'").select(key)
    changed = delta.where("op in ('set', 'new')").select(key, "new.*")
    return prev.join(gone, key, "left_anti").join(changed.select(key), key, "left_anti").unionByName(changed.select(key, *rest))


def _runs(batches):
    """One row a partition: is it in order, and its ends as (is new, place)."""
    first = last = None
    ok = True
    for batch in batches:
        new, place, now = (batch.column(k).to_pylist() for k in range(3))
        for here in zip(new, place, now):
            ok = ok and (last is None or last[:2] < here[:2])
            first, last = first or here, here
    if first is not None:
        yield pa.RecordBatch.from_pylist([{"ok": ok, "a_new": first[0], "a": first[1], "now": first[2], "z_new": last[0], "z": last[1]}])


def keeps_order(prev: DataFrame, curr: DataFrame, key: str, order: str) -> DataFrame:
    """One row: may the later snapshot be written as survivors in their old order, then new rows?

    The later rows are range-sorted; each partition says whether it is in order, and only
    its two ends are compared with its neighbours'.
    """
    both = prev.select(key, F.col(order).cast("long").alias("was")).join(curr.select(key, F.col(order).cast("long").alias("now")), key, "right")
    rows = both.select(F.col("was").isNull().alias("new"), F.coalesce("was", "now").alias("place"), "now")
    ends = rows.repartitionByRange("now").sortWithinPartitions("now").mapInArrow(_runs, "ok boolean, a_new boolean, a long, now long, z_new boolean, z long")
    before = F.lag(F.struct("z_new", "z")).over(Window.orderBy("now"))  # one row a partition
    joined = F.coalesce(before < F.struct("a_new", "a"), F.lit(True))
    return ends.withColumn("ok", F.col("ok") & joined).agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("representable"))


def key_diff(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """Shallow object delta of (id, key, value) rows: (id, key, op, value)."""
    a = prev.select("id", "key", F.col("value").alias("old"), F.lit(True).alias("was"))
    b = curr.select("id", "key", F.col("value").alias("new"), F.lit(True).alias("is"))
    both = a.join(b, ["id", "key"], "full_outer")
    op = F.when(F.col("is").isNull(), "del").when(F.col("was").isNull() | ~F.col("old").eqNullSafe(F.col("new")), "set")
    return both.select("id", "key", op.alias("op"), F.col("new").alias("value")).where("op is not null")


def key_apply(prev: DataFrame, delta: DataFrame) -> DataFrame:
    kept = prev.join(delta.select("id", "key"), ["id", "key"], "left_anti")
    return kept.unionByName(delta.where("op = 'set'").select("id", "key", "value"))


def diff_key_discovery(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """(ordinal, column, usable): present everywhere, text or whole number, unique within each side.

    One pass a side: counts and distinct counts of every candidate column together.
    """
    columns = [c for c in prev.columns if c in curr.columns]
    kinds = dict(prev.dtypes)

    def profile(df: DataFrame, tag: str) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias("rows")] + [F.count(c).alias(f"c_{c}") for c in columns] + [F.count_distinct(c).alias(f"d_{c}") for c in columns]
        facts = df.agg(*aggs)
        whole = [F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column"), ((F.col(f"c_{c}") == F.col("rows")) & (F.col(f"d_{c}") == F.col("rows"))).alias(tag)) for i, c in enumerate(columns)]
        return facts.select(F.explode(F.array(*whole)).alias("x")).select("x.*")

    scalar = reduce(lambda e, c: F.when(F.col("column") == c, F.lit(kinds[c] in ("string", "bigint", "int", "smallint", "tinyint"))).otherwise(e), columns, F.lit(False))
    both = profile(prev, "p").join(profile(curr, "q"), ["ordinal", "column"])
    return both.select("ordinal", "column", (F.col("p") & F.col("q") & scalar).alias("usable"))

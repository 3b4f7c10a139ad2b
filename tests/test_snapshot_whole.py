"""The order test of snapshots runs over all orders."""

from pyspark.sql import functions as F

from sparloom.plans import relational


def test_keeps_order_sees_all_orders(spark, sf, monkeypatch):
    seen, real = [], relational.snapshot.keeps_order
    monkeypatch.setattr(relational.snapshot, "keeps_order", lambda *a: seen.append(a) or real(*a))
    assert relational.snapshot_keeps_order(spark, sf).first()[0] is True
    prev, curr, key, order = seen[0]
    keys = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
    assert prev.select("k").union(curr.select("k")).distinct().count() == keys.distinct().count()
    assert prev.join(curr, "k", "left_anti").count() and curr.join(prev, "k", "left_anti").count()
    # the last survivor put before all others
    last = curr.join(prev.select("k"), "k").agg(F.max("k")).first()[0]
    moved = curr.withColumn("ord", F.when(F.col("k") == last, F.lit(-(1 << 63) + 1)).otherwise(F.col("ord")))
    assert real(prev, moved, key, order).first()[0] is False

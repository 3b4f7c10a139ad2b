"""Connected components of a link table, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def components(links: DataFrame, ws: Workspace, name: str = "cc", most_rounds: int = 60) -> DataFrame:
    """(id, root): the smallest id reachable from each end of ``links(a, b)``.

    Large-star and small-star rounds until nothing changes.  Each round takes
    the least neighbour by a partially aggregated min and joins it back, so a
    hub needs no gathered list.  The minima are written first, so both sides of
    the join are plain exchanges and AQE can split a hub's side.  Every round is
    a table in the shared folder.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    edges = ws.save(edges, f"{name}-0")
    before = None
    for number in range(1, most_rounds + 1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ws.save(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), f"{name}-least-{number}")
        # large star: neighbours above a node hang on its least neighbour
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        # small star: a node and its neighbours below hang on the least of them
        down = large.select(F.col("b").alias("n"), F.col("a").alias("x"))
        low = ws.save(down.groupBy("n").agg(F.min("x").alias("m")), f"{name}-low-{number}")
        small = down.join(low, "n").select(F.col("m").alias("a"), F.explode(F.array("n", "x")).alias("b")).where("a < b").distinct()
        edges_new = ws.save(small, f"{name}-{number}")
        now = edges_new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        ws.drop(f"{name}-{number - 1}", f"{name}-least-{number}", f"{name}-low-{number}")
        edges = edges_new
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("b").alias("id"), F.col("a").alias("root"))

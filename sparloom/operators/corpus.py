"""Captured payloads: first sightings, retention, coverage, attribution, grouping."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P

# A pause, or a span from its first block, that parts two results (ns).
PAUSE_NS, SPAN_NS = 50_000_000, 250_000_000
KEEP_PER_TOOL = 200


def first_sightings(payloads: DataFrame) -> DataFrame:
    """One row per (tool, sha): its earliest capture, with what came with it."""
    rest = [c for c in payloads.columns if c not in ("tool", "sha")]
    tool = P.sanitize(F.col("tool"))
    rows = payloads.withColumn("tool", tool)
    first = F.min_by(F.struct(*rest), F.struct("captured_at", *[c for c in ("server", "doc_id") if c in rest]))
    return rows.groupBy("tool", "sha").agg(first.alias("f"), F.count(F.lit(1)).alias("sightings")).select("tool", "sha", "sightings", "f.*")


def newest(payloads: DataFrame, keep: int = KEEP_PER_TOOL) -> DataFrame:
    """The newest rows of each tool."""
    order = Window.partitionBy("tool").orderBy(F.desc("captured_at"), "sha")
    return payloads.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep).drop("place")


def coverage(payloads: DataFrame, shape) -> DataFrame:
    """Counts by tool, by shape and over all."""
    rows = payloads.withColumn("shape", shape)
    return rows.groupingSets([["tool"], ["shape"], []], "tool", "shape").agg(F.count(F.lit(1)).alias("payloads"), F.grouping_id().alias("level"))


def attribution(payloads: DataFrame) -> DataFrame:
    """A payload without server adopts the only server seen for its tool; ``how`` says so."""
    own = F.nullif("server", F.lit(""))
    servers = payloads.groupBy(F.col("tool").alias("of")).agg(F.min(own).alias("least"), F.max(own).alias("most"))
    seen = payloads.join(servers, F.col("tool").eqNullSafe(F.col("of"))).drop("of")
    only = F.when(F.col("least") == F.col("most"), F.col("least"))
    how = F.when(own.isNotNull(), "recorded").when(only.isNotNull(), "adopted").otherwise("unknown")
    return seen.withColumn("how", how).withColumn("server", F.coalesce(own, only)).drop("least", "most")


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Group numbers of rows in order of tool and time; the span is measured from the group's first row, so it is a fold."""
    of, group, start, last = None, None, None, None
    for rows in batches:
        numbers = []
        for tool, at in zip(rows["tool"].tolist(), rows["captured_at"].tolist()):
            if group is None or tool != of:
                of, group, start = tool, 0, at
            elif at - last >= PAUSE_NS or at - start >= SPAN_NS:
                group, start = group + 1, at
            last = at
            numbers.append(group)
        yield rows.assign(group_no=numbers)


def group_by_pause(payloads: DataFrame) -> DataFrame:
    """(tool, sha, captured_at, group_no): blocks of one result by pause and span.

    Rows are sorted by the engine and folded as they pass, so a worker holds one batch,
    however long the rows of a tool follow each other without a pause.
    """
    rows = payloads.where("captured_at is not null").select("tool", "sha", "captured_at")
    return rows.repartition("tool").sortWithinPartitions("tool", "captured_at", "sha").mapInPandas(_numbered, "tool string, sha string, captured_at long, group_no long")


def group_by_result(payloads: DataFrame) -> DataFrame:
    """Blocks of one result by its recorded id."""
    return payloads.where("result_id is not null").groupBy("tool", "result_id").agg(F.array_sort(F.collect_list(F.struct("captured_at", "raw"))).alias("blocks"))


def identities(payloads: DataFrame) -> DataFrame:
    """(name, tool, server): every tool under its qualified name, after attribution."""
    rows = attribution(payloads).select("tool", "server").distinct()
    return rows.select(F.concat_ws(".", "server", "tool").alias("name"), "tool", "server")


def heuristic_share(payloads: DataFrame) -> DataFrame:
    """Payloads that are grouped by their times, because they have no result id, among all."""
    return payloads.agg(F.count_if(F.col("result_id").isNull() & F.col("captured_at").isNotNull()).alias("guessed"), F.count(F.lit(1)).alias("payloads"))

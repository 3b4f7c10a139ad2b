"""Synthetic payloads of known shape, from ranges and structs, and a churn of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _pick(values: list[str], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(at, F.lit(len(values))) + 1).cast("int"))


def _records(n: int, record) -> Column:
    return F.to_json(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), record), {"ignoreNullFields": "false"})


def stress_corpus(spark: SparkSession) -> DataFrame:
    """(shape, raw): wide, long, heavily repeating, nested, mixed and object-valued record lists."""
    status, team = ["active", "suspended for review", "closed", "pending"], ["platform", "payments", "search"]
    config = lambda i: F.when(i % 3 == 0, '{"mode":"fast","retries":3}').when(i % 3 == 1, '{"mode":"safe","retries":9,"audit":true}').otherwise('{"mode":"off"}')
    shapes = {
        "wide_table": _records(8, lambda i: F.struct(i.alias("id"), *((i * 7 + c * 13).alias(f"col_{c:02d}") for c in range(1, 12)))),
        "long_table": _records(40, lambda i: F.struct(i.alias("id"), F.concat(F.lit("label-"), i).alias("label"), (i * 3 % 17).alias("weight"))),
        "heavy_alias": _records(16, lambda i: F.struct(i.alias("id"), _pick(status, i).alias("status"), _pick(team, i).alias("team"), (i % 5).alias("priority"))),
        "nested_records": _records(10, lambda i: F.struct(i.alias("id"), F.struct(_pick(["ann", "bo", "cy"], i).alias("name"), _pick(team, i).alias("team")).alias("owner"), _pick(status, i).alias("status"), (i * i).alias("count"))),
        "mixed_realistic": _records(12, lambda i: F.struct(i.alias("id"), F.concat(F.lit("item "), i).alias("name"), _pick(status, i).alias("status"), _pick(team, i).alias("team"), (i * 1.5).alias("size_kb"), (i % 2 == 0).alias("active"))),
        "object_alias": F.concat(F.lit("["), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.concat(F.lit('{"id":'), i, F.lit(',"name":"svc-'), i, F.lit('","config":'), config(i), F.lit("}"))), ","), F.lit("]")),
    }
    one = spark.range(1)
    rows = [one.select(F.lit(name).alias("shape"), raw.alias("raw")) for name, raw in shapes.items()]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3]).union(rows[4]).union(rows[5])


def churn(records: Column, field: str, key: str) -> Column:
    """The next result of a poll: ``field`` changes in the first two records and one record is appended."""
    changed = F.transform(records, lambda r, i: F.when(i < 2, r.withField(field, F.concat(r[field].cast("string"), F.lit("*")))).otherwise(r.withField(field, r[field].cast("string"))))
    last = F.element_at(changed, -1)
    return F.concat(changed, F.array(last.withField(key, F.array_max(F.transform(records, lambda r: r[key])) + 1)))

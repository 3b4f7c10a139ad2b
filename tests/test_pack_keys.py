"""Replies of a pack meet their own payload only."""

from compare import differences

from sparloom.operators import payloads as ops
from sparloom.plans import catalog


def test_equal_hashes_of_two_tools_do_not_cross(spark):
    rows = spark.createDataFrame([("a", "5eed", '[{"id":1},{"id":2}]'), ("b", "5eed", '[{"id":1},{"id":2},{"id":9}]')], "tool string, sha string, raw string")
    pack = ops.build_pack(rows)
    replies = pack.selectExpr("'m' AS model", "tool", "sha", "qid", "'form' AS form", "array(expected) AS replies")
    scored = ops.score_pack(pack, replies).collect()
    assert len(scored) == pack.count() and all(r.ok == r.trials == 1 for r in scored)


def test_a_payload_without_tool_is_scored(spark):
    rows = spark.createDataFrame([(None, "5eed", '[{"id":1},{"id":2}]'), ("b", "5eed", '[{"id":1},{"id":3}]')], "tool string, sha string, raw string")
    pack = ops.build_pack(rows)
    replies = pack.selectExpr("'m' AS model", "tool", "sha", "qid", "'form' AS form", "array(expected) AS replies")
    scored = ops.score_pack(pack, replies).collect()
    assert len(scored) == pack.count() and {r.tool for r in scored} == {None, "b"} and all(r.ok == r.trials == 1 for r in scored)


def test_odd_orders_are_scored_as_in_the_sql(spark, tmp_path):
    """Order keys that repeat, lack or are negative, unlike customers with equal payloads, no customer, one order only."""
    orders = [(7, 1, "F"), (7, 1, "F"), (8, 2, "F"), (8, 2, "O"), (8, 2, "O"), (None, 3, "F"), (9, 3, "F"), (None, 4, None), (None, 4, None), (5, 5, None), (6, 5, "P")]
    orders += [(-1, 7, "F"), (-3, 7, "O"), (-1, 8, "F"), (-3, 8, "O"), (20, None, "F"), (21, None, "F"), (22, 10, "F")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    assert not differences(spark, str(tmp_path), catalog.QUERIES["score_pack"], catalog.ORACLE_SQL["score_pack"])

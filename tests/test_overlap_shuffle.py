"""Overlaps of pairs compare two texts in a row; their tokens are not shuffled."""

import compare
import pytest

from sparloom.plans import relational as R


@pytest.mark.parametrize("name", ["pair_overlap", "cross_server_overlap", "pair_overlap_idf"])
def test_equals_its_sql(spark, sf, name):
    assert not compare.differences(spark, sf, R.QUERIES[name], R.ORACLE_SQL[name])


@pytest.mark.parametrize("name", ["pair_overlap", "cross_server_overlap"])
def test_no_tokens_are_exploded(spark, sf, name):
    plan = R.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in plan and "explode(regexp_extract_all" not in plan


def test_texts_of_one_id_count_together(spark):
    from sparloom.operators import probes

    rows = spark.createDataFrame([(1, "a b b"), (1, "b c"), (2, "b b b b c"), (3, None)], "id long, text string")
    pairs = spark.createDataFrame([(1, 2), (3, 2), (2, 3)], "prev long, curr long")
    got = {(r.prev, r.curr): (r.curr_tokens, r.shared_tokens) for r in probes.pair_overlap(pairs, rows, "id", "text").collect()}
    assert got == {(1, 2): (5, 4), (3, 2): (5, 0)}

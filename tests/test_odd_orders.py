"""Orders whose keys repeat or lack are asked about like all others."""

import pytest
from compare import differences

from sparloom.plans import catalog

ORDERS = [(7, 1, "F"), (7, 1, "F"), (8, 2, "F"), (8, 2, "O"), (None, 3, "F"), (9, 3, "F"), (None, 4, None), (None, 4, None), (5, 5, None), (6, 5, "P"), (20, None, "F"), (21, None, "F")]
#: mostly nulls: such records fill less than half of a table unless the nulls are kept
ORDERS += [(None, 11, None), (None, 11, None), (None, 11, None), (30, 11, "F"), (None, 12, None), (None, 12, None), (None, 12, None), (None, 12, "O"), (None, 13, "F"), (31, 13, None), (-2, 13, None)]


@pytest.mark.parametrize("name", ["score_pack", "question_count", "question_enumerate", "question_max", "evaluate_forms"])
def test_as_in_the_sql(spark, tmp_path, name):
    spark.createDataFrame(ORDERS, "o_orderkey long, o_custkey long, o_orderstatus string").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    assert not differences(spark, str(tmp_path), catalog.QUERIES[name], catalog.ORACLE_SQL[name])

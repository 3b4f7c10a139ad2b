"""A fold takes a session batch by batch: no group is gathered in Python."""

from sparloom.plans import accounts
from sparloom.streaming import machines, run


def test_fold_gathers_no_group(spark, sf):
    plan = accounts.transform_fold(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan


def test_state_outlives_a_batch_and_ends_with_its_key(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        rows = spark.createDataFrame([(s, n, f"h{n % 3}", "put" if n < 3 else "get", "x") for s in ("a", "b") for n in range(7, -1, -1)], "session string, seq long, handle string, op string, value string")
        got = sorted(map(tuple, run.fold(rows, machines.DropStore, "session").collect()))
    finally:
        spark.conf.set(key, before)
    assert got == [(s, n, f"h{n % 3}", "stored" if n < 3 else "hit", min(n + 1, 3)) for s in ("a", "b") for n in range(8)]


def test_groups_without_a_pause_pass_in_batches(spark):
    """Rows that never pause are one group of the engine no longer, and come out as a plain fold has them."""
    from sparloom.operators import corpus

    step = 12_000_000
    rows = [(tool, f"s{n % 7}", (n * 37 % 200) * step + (n // 150) * corpus.PAUSE_NS) for tool in ("a", "b", None) for n in range(300)] + [("a", "none", None)]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        out = corpus.group_by_pause(spark.createDataFrame(rows, "tool string, sha string, captured_at long"))
        assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().optimizedPlan().toString()
        got = sorted(map(tuple, out.collect()), key=repr)
    finally:
        spark.conf.set(key, before)
    want = []
    for tool in ("a", "b", None):
        group, start, last = -1, None, None
        for _, sha, at in sorted((r for r in rows if r[0] == tool and r[2] is not None), key=lambda r: (r[2], r[1])):
            if last is None or at - last >= corpus.PAUSE_NS or at - start >= corpus.SPAN_NS:
                group, start = group + 1, at
            last = at
            want.append((tool, sha, at, group))
    assert got == sorted(want, key=repr)


def test_a_key_of_a_stream_is_asked_once():
    """One message for the state, not two, and rows in order whatever batches they come in."""
    import pandas as pd

    class Value:
        asked, held = 0, None

        def get(self):
            Value.asked += 1
            return Value.held

        def update(self, row):
            Value.held = row

    processor = run.MachineProcessor(machines.DropStore)
    processor.value = Value()
    part = lambda *seq: pd.DataFrame({"session": "s", "seq": seq, "handle": "h", "op": ["put" if n == 1 else "get" for n in seq], "value": [None] * len(seq)})
    out = pd.concat(list(processor.handleInputRows(("s",), iter([part(3, 2), part(1)]), None)))
    assert out["outcome"].tolist() == ["stored", "hit", "hit"] and Value.asked == 1
    assert pd.concat(list(processor.handleInputRows(("s",), iter([part(4)]), None)))["outcome"].tolist() == ["hit"]

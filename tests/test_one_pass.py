"""Payloads pass through Python once, and only those that have to."""

import json

from sparloom.kernel.codec import LONG_TEXT
from sparloom.operators import payloads as ops
from sparloom.plans import payload_queries


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_judged_and_cut_in_one_pass(spark):
    block = "```\n" + "x" * LONG_TEXT + "\n```\n"
    texts = [("a", block), ("a", "b\n" + block), ("a", "short"), ("a", None), ("b", block), ("b", json.dumps({"t": "y" * LONG_TEXT})), ("c", "z" * LONG_TEXT), ("c", "z" * LONG_TEXT), (None, block), (None, block)]
    out = ops.text_drop_candidates(spark.createDataFrame(texts, "tool string, raw string"))
    assert _plan(out).count("ArrowEvalPython") == 1
    got = sorted(map(tuple, out.select("tool", "payloads", "tokens", "block_tokens").collect()), key=repr)
    n = len(block)
    assert got == [("a", 2, n // 4 + (n + 2) // 4, 2 * (n // 4)), (None, 2, 2 * (n // 4), 2 * (n // 4))]


def test_a_payload_is_emitted_before_its_questions(spark, sf):
    plan = _plan(payload_queries.evaluate_forms(spark, sf))
    assert plan.index("MapInPandas") < plan.index("PythonUDTF") < plan.index("ArrowEvalPython")


def test_a_payload_is_read_once_for_all_its_questions():
    payload_queries._answers.cache_clear()
    raw = '[{"o_orderkey":1,"s":"F"},{"o_orderkey":5,"s":"O"}]'
    asked = payload_queries.questions(json.loads(raw))
    assert [payload_queries.stub_answer("control", q.prompt, raw) for q in asked] == [payload_queries.minify(q.expected).strip('"') for q in asked]
    assert payload_queries._answers.cache_info().misses == 1 and payload_queries.stub_answer("control", asked[0].prompt, "no") == "?"

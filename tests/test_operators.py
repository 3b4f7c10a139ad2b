import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparloom.functions import predicates as P
from sparloom.operators import evaluation, ledger, payloads, policy, sequence
from sparloom.sources import files
from sparloom.streaming import machines


def test_windows_globs_and_names(spark):
    rows = spark.createDataFrame([("30m",), ("7d",), ("x",), (" 2w ",)], "w string")
    assert [r[0] for r in rows.select(P.window_seconds(F.col("w"))).collect()] == [1800, 604800, None, 1209600]
    names = spark.createDataFrame([("a.b",), ("a.b\n",), ("axb",), ("A.b",), ("a]b",)], "n string")
    hit = lambda g: [r[0] for r in names.where(F.col("n").rlike(P.glob_to_regex(g))).collect()]
    assert hit("a.?") == ["a.b"] and hit("a.*") == ["a.b", "a.b\n"] and hit("a[!.]b") == ["axb", "a]b"] and hit("a[]]b") == ["a]b"]
    t = spark.createDataFrame([("kb", "kb__read"), ("kb", "kb__"), ("kb", "x__read")], "s string, t string")
    assert [r[0] for r in t.select(P.canonical_tool(F.col("s"), F.col("t"))).collect()] == ["read", "kb__", "x__read"]


def test_policy_prefers_names_over_rules(spark):
    rules = policy.rules_table(spark, {"version": 1, "rules": [{"tool": "structure", "tiers": []}, {"tool": "own.*", "tiers": ["minify"]}]})
    rows = spark.createDataFrame([("structure", "own"), ("structure", None), ("peer__structure", None), ("other", None)], "tool string, server string")
    got = {(r.tool, r.server): r.glob for r in policy.select_rules(rows, rules).collect()}
    assert got == {("structure", "own"): "own.*", ("structure", None): "structure", ("peer__structure", None): "structure", ("other", None): "*"}
    assert policy.dead_rules(["gh.*", "gh.a", "*", "z"]) == [1, 3]
    assert [r["tool"] for r in policy.merge([{"tool": "*"}], [{"tool": "a.b"}])] == ["a.b", "*"]
    for bad in ({"version": 2}, {"version": 1, "x": 1}, {"version": 1, "diff": 1}, {"version": 1, "rules": [{"tool": ""}]}):
        with pytest.raises(policy.PolicyError):
            policy.load(bad)


def test_standard_errors(spark):
    rows = spark.createDataFrame([("m", 1, 4, 3), ("m", 2, 4, 1), ("m", 3, 0, 0)], "model string, question int, trials int, form_ok int")
    r = evaluation.accuracy(rows, "form_ok", "model").first()
    assert (r.n, r.trials, r.acc) == (2, 8, 0.5) and abs(r.se - (2 / 1 * (1 + 1)) ** 0.5 / 8) < 1e-12
    one = evaluation.accuracy(rows.where("question = 1"), "form_ok", "model").first()
    assert abs(one.se - (4 * 0.75 * 0.25) ** 0.5 / 4) < 1e-12
    with pytest.raises(PySparkException):
        evaluation.accuracy(rows.withColumn("form_ok", F.lit(9)), "form_ok", "model").collect()


def test_null_tokens_never_count(spark):
    row = "ts long, version string, server string, tool string, event string, decision string, diff_reason string, raw_chars int, out_chars int, raw_tokens int, out_tokens int"
    rows = spark.createDataFrame([(1, None, "s", "s__t", None, "diff", None, 8, 4, None, 1), (2, "v", "s", "t", None, "unchanged", None, 8, 8, 2, 2), (3, "v", "s", "t", None, "x", None, None, 1, 1, 1)], row)
    r = ledger.by_tool(rows).first()
    assert (r.tool, r.blocks, r.tokenized, r.encoded, r.raw_tokens) == ("t", 2, 1, 1, 2)
    assert ledger.totals(rows).first().untokenized == 1 and ledger.totals(ledger.since(rows, 2)).first().blocks == 1


def test_names_qualified_again(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "a__x"), ("c", "y")], "peer string, name string")
    got = {(r.peer, r.name): r.exposed for r in sequence.expose_names(rows).collect()}
    assert len(set(got.values())) == 4 and got["c", "y"] == "y" and got["b", "x"] == "b__x"


def test_files(spark, tmp_path):
    (tmp_path / "c").mkdir()
    for name, text in (("b.json", json.dumps({"tool": "t", "raw": "x", "captured_at": 2})), ("a.json", '{"tool": "t", "raw": "y"}'), ("bad.json", "{"), ("_side.json", "{}"), ("no.json", '{"tool": "t"}')):
        (tmp_path / "c" / name).write_text(text)
    assert [r.raw for r in files.read_corpus(spark, f"{tmp_path}/c").collect()] == ["y", "x"]
    assert files.corrupt_files(spark, f"{tmp_path}/c").first().corrupt == 1
    (tmp_path / "l.jsonl").write_text('{"ts": 5, "raw_chars": 1}\n{"ts": 9}\n{"raw_chars": 2}\n{"ts": 1')
    assert files.read_ledger(spark, f"{tmp_path}/l.jsonl").count() == 3 and files.read_ledger(spark, f"{tmp_path}/l.jsonl", since=9).count() == 1
    use = {"input_tokens": 1, "cache_creation_input_tokens": 2, "cache_read_input_tokens": 3, "output_tokens": 4}
    line = json.dumps({"requestId": "r", "message": {"id": "m", "usage": use}})
    (tmp_path / "s.jsonl").write_text(line + "\n" + line + "\n" + json.dumps({"requestId": "r2", "message": {"id": "m2", "usage": use}}))
    assert tuple(files.session_usage(spark, f"{tmp_path}/s.jsonl").first())[1:] == (2, 2, 4, 6, 8)


def test_reduction_fails_closed(spark):
    rows = spark.createDataFrame([('{"a": 3}',), ('{"r": [{"b": "' + "z" * 300 + '"}]}',), (None,), ("text",)], "raw string")
    fields = {"r[].b": {"lossy": "drop-to-retrieve"}}
    got = rows.select(payloads.reduce_fields(F.col("raw"), F.lit("t"), fields).alias("r")).select("r.*").collect()
    assert got[0].gate and len(got[1].drops) == 1 and got[2].text is None and got[3].text == "text"
    odd = rows.select(payloads.reduce_fields(F.lit('{"r": 1}'), F.lit("t"), fields).alias("r")).first().r
    assert not odd.gate and odd.text == '{"r": 1}'


def test_machines_evict_and_reset():
    store = machines.DropStore(most=2)
    step = lambda op, h, v="": store.step({"session": "s", "seq": 0, "handle": h, "op": op, "value": v})[0]
    for op, h, outcome in (("put", "a", "stored"), ("put", "b", "stored"), ("get", "a", "hit"), ("put", "c", "stored"), ("get", "b", "miss"), ("get", "a", "hit"), ("reset", "", "cleared"), ("get", "a", "miss")):
        assert step(op, h)[3] == outcome
    again = machines.DropStore(store.state())
    assert again.held == store.held
    seen = machines.Correlator()
    for i in range(1100):
        seen.step({"session": "s", "seq": i, "id": str(i), "dir": "request", "tool": "t", "args": ""})
    assert len(seen.pending) == 1024 and seen.step({"session": "s", "seq": 0, "id": "3", "dir": "response"})[0][4] == "unmatched"
    primer = machines.LazyPrimer()
    row = {"session": "s", "seq": 1, "raw": '{"__loom_dict__":1}', "dir": "response"}
    assert primer.step(row | {"structured": "{}"})[0][2] == "suppressed" and not primer.step(row | {"structured": "{}"}) and primer.step(row)[0][2] == "attached" and not primer.step(row)
    text = machines.TextChain()
    base = " ".join(f"word{i}" for i in range(400))
    reasons = [text.step({"session": "s", "tool": "t", "seq": i, "raw": base + f" tail {i}"})[0][3] for i in range(8)]
    assert reasons[0] == "no_prior" and reasons[1:6] == ["emitted"] * 5 and reasons[6] == "keyframe"


def test_reports(spark):
    from sparloom.operators import report

    df = spark.createDataFrame([("a|b", 2.0, None), ("c", -1.0, 3)], "name string, v double, n int").orderBy("name")
    assert report.markdown(df, "T").splitlines()[-2:] == ["| a\\|b | 2.0 | — |", "| c | -1.0 | 3 |"]
    assert report.html_bars(df, "name", "v").count("<rect") == 2 and report.sparkline([0, None, 5, 10]) == "▁ ▄█"
    assert "o" in report.forest("m", 0.01, 0.1) and report.diverging("x", -1, 2).rstrip().endswith("|")
    assert json.loads(report.as_json(total=df.limit(1), rows=df))["total"]["v"] == 2.0


def test_primer_sections():
    from sparloom.kernel.primer import primer

    assert primer({"rules": [{"tool": "*", "tiers": ["minify"]}]}) == "" and "cols" in primer({"rules": [{"tiers": ["tabularize"]}]}, {"rules": []})
    assert "fetched" in primer({"rules": [{"tiers": [], "fields": {"a": {"lossy": "drop-to-retrieve"}}}]})


def test_text_aliases():
    from sparloom.kernel import textalias

    text = "the quick brown fox jumps over it\n" * 20 + "another line of words that is here\n" * 3 + "§ sign"
    for mode in ("line", "phrase", "block"):
        coded, legend = textalias.encode(text, mode)
        assert legend and textalias.decode(coded, legend) == text and len(coded) < len(text)
    assert textalias.sigil_for("".join(textalias.SIGILS) + "«0»") == "«1»"

"""Liability of installed entries, JSON contracts and reports on hand-made cases."""

import json

import pytest
from pyspark.sql import functions as F

from sparloom.operators import ledger, liability, payloads, report

SCAN = "server string, scope string, position int, state string, wraps string, ledger_identity string, ledger_identity_explicit boolean, primer_tokens long"
ROWS = "ts long, version string, server string, tool string, decision string, diff_reason string, raw_chars long, out_chars long, raw_tokens long, out_tokens long, event string, path string, hit boolean, bytes long, tokens long, cadence string, attached boolean"


def result(server, n=1, raw=100, out=40, tokens=True, decision="compressed"):
    return [(1, "v1", server, "t", decision, None, raw * 4, out * 4, raw if tokens else None, out if tokens else None, None, None, None, None, None, None, None)] * n


def primer(server, attached=True, tokens=None, size=0, cadence="once/session"):
    return [(1, "v1", server, None, None, None, None, None, None, None, "primer", None, None, size, tokens, cadence, attached)]


@pytest.fixture(scope="module")
def owed(spark):
    entries = [
        ("hub", "user", 1, "router", "a, b", None, None, 200), ("lonely", "user", 2, "router", "(no peers)", None, None, 90), ("one", "user", 3, "wrapped", "/opt/one --x", None, None, 300),
        ("one", "project", 4, "wrapped", "/opt/other", None, None, 999), ("py1", "user", 5, "wrapped", "python3 -m x", None, None, 50), ("py2", "user", 6, "wrapped", "python3 -m y", None, None, 50),
        ("renamed", "user", 7, "wrapped", "/opt/old", "renamed", True, 60), ("quiet", "user", 8, "wrapped", "/opt/quiet", None, None, 70), ("measured", "user", 9, "wrapped", "/opt/measured", None, None, 70),
        ("late", "user", 10, "wrapped", "/opt/late", None, None, 70), ("folded", "user", 11, "folded", "/opt/old2", None, None, 10), ("never", "user", 12, "wrapped", "/opt/never", None, None, 70),
    ]
    rows = result("a", 3) + result("b", 2, 50, 60) + result("one", 4) + result("old", 5) + result("python3", 7) + result("quiet", 2) + result("measured", 2) + result("late", 1, tokens=False)
    rows += primer("quiet", False) + primer("measured", True, 30) + primer("measured", True, 50) + primer("late", False) + primer("late", True, None, 12)
    entries, rows = spark.createDataFrame(entries, SCAN), spark.createDataFrame(rows, ROWS)
    tools, sent = ledger.by_tool(rows), ledger.primers(rows)
    own = liability.liability(entries, tools, sent).cache()
    return entries, rows, {r.server: r for r in own.collect()}, liability.totals(own, ledger.totals(rows)).first()


def test_labels(owed):
    got = owed[2]
    assert set(got) == {"hub", "lonely", "one", "py1", "py2", "renamed", "quiet", "measured", "late", "never"}
    assert got["hub"].labels == ["a", "b"] and got["lonely"].labels == [] and got["one"].labels == ["one"] and got["one"].scope == "user"
    assert got["py1"].labels == [] and got["py1"].verdict_reason == got["py2"].verdict_reason == "ambiguous ledger label"
    assert got["renamed"].superseded_labels == ["old"] and not got["one"].superseded_labels and got["renamed"].blocks == 0


def test_primers_and_blocks(owed):
    got = owed[2]
    assert (got["hub"].blocks, got["hub"].tokenized, got["hub"].saved, got["hub"].cadence) == (5, 5, 160, "per-turn")
    assert (got["lonely"].blocks, got["lonely"].verdict) == (0, "UNWRAP")
    assert (got["quiet"].primer_tokens, got["quiet"].primer_source, got["quiet"].cadence) == (0, "recorded", "once/session (unpaid)")
    assert (got["measured"].primer_tokens, got["measured"].primer_source, got["measured"].cadence) == (40, "recorded", "once/session")
    # it attached without a size: paid, but estimated; and none of its blocks has tokens
    assert (got["late"].primer_tokens, got["late"].primer_source, got["late"].verdict_reason) == (70, "estimated", "no token data")
    assert got["one"].blocks_to_break_even == 5 and got["one"].verdict == "TUNE" and [c.label for c in got["one"].contributors] == ["one"]


def test_totals(owed):
    t = owed[3]
    assert t.per_turn_tokens == 290 and t.session_once_tokens == 300 + 40 + 70 and t.unresolved == 0
    assert t.idle == ["lonely"] and t.free == ["never", "quiet", "renamed"] and t.uncertain == ["py1", "py2"]
    assert t.saved_tokens == 160 + 4 * 60 + 5 * 60 + 7 * 60 + 2 * 60 + 2 * 60 and abs(t.turns_covered - t.saved_tokens / 290) < 1e-9


def test_stats_json(owed):
    entries, rows, *_ = owed
    made = json.loads(report.stats_json(rows, entries))
    assert set(made) == {"total", "decisions", "diff_reasons", "versions", "tools", "retrieves", "primers", "primer_liability"}
    assert made["total"]["blocks"] == 26 and made["total"]["untokenized"] == 1 and made["decisions"] == {"compressed": 26}
    assert set(made["primer_liability"]) == {"servers", "per_turn_tokens", "session_once_tokens", "unresolved", "idle", "free", "uncertain", "saved_tokens", "turns_covered", "session_covered"}
    assert made["primer_liability"]["servers"][0]["verdict"] == "UNWRAP" and json.loads(report.stats_json(rows))["primer_liability"] is None


def test_verify_json(spark):
    rows = spark.createDataFrame([("t", "s1", '[{"a":1,"b":"word"},{"a":2,"b":"word"}]'), ("t", "s2", "plain"), ("u", "s3", '{"a": 1}')], "tool string, sha string, raw string")
    made = json.loads(report.verify_json(rows.select("tool", "sha", payloads.measure(F.col("raw")).alias("m")), "here"))
    assert made["payloads"] == 3 and made["lossless_gate"] == {"ok": True, "passed": 3, "total": 3, "failures": []} and made["embedded_gate"]["evaluated"] == 3
    assert set(made["by_shape"]) == {"array-of-records", "compact-json", "other"} and made["coverage"]["by_tool"] == {"t": 2, "u": 1}
    assert made["tokens"]["n"] == 3 and made["tokens"]["raw_tokens"] - made["tokens"]["packed_tokens"] == made["tokens"]["saved_tokens"]


def test_reports_hold_all_rows_or_say_so(spark):
    df = spark.range(1500).select(F.col("id").alias("n"), (F.col("id") / 2).alias("v"), F.lit(0.1).alias("ci"))
    assert report.markdown(df).count("\n") == 1501 and "there are more" in report.markdown(df, most=10) and "there are more" not in report.markdown(df.limit(10), most=10)
    assert report.html_bars(df, "n", "v").count("<rect") == 1500 and report.html_stacked(df.limit(3), "n", ["v", "ci"]).count("<rect") == 6
    assert report.html_forest(df.limit(3), "n", "v", "ci").count("<circle") == 3 and len(json.loads(report.as_json(rows=df))["rows"]) == 1500
    assert report.sections("All", one=df.limit(2), two_more=df.limit(1)).count("## ") == 2


def test_ledger_rows_of_writers(spark):
    one = spark.range(1)
    got = one.select(ledger.retrieve_row("s", F.lit(5), F.lit("t"), F.lit("$.a"), F.lit("some text")).alias("r"), ledger.retrieve_row("s", F.lit(5), F.lit("t"), F.lit("$.a"), F.lit(None).cast("string")).alias("m"), ledger.primer_row("s", F.lit(5), F.lit("use it so"), F.lit(False)).alias("p")).first()
    assert (got.r.hit, got.r.bytes, got.r.tokens) == (True, 9, 2) and (got.m.hit, got.m.bytes, got.m.tokens) == (False, 0, 0) and (got.p.attached, got.p.tokens) == (False, 0)


def test_files_of_sinks(spark, tmp_path):
    from sparloom.sources import files

    rows = spark.createDataFrame(result("a", 2), ROWS)
    files.append_ledger(rows, f"{tmp_path}/ledger")
    files.append_ledger(rows, f"{tmp_path}/ledger")
    assert ledger.totals(files.read_ledger(spark, f"{tmp_path}/ledger/*")).first().blocks == 4
    runs = spark.createDataFrame([(1, "x", 2, 2, 10, 5, 5, 50.0)], files.HISTORY)
    files.append_history(runs, f"{tmp_path}/history")
    assert [tuple(r) for r in files.read_history(spark, f"{tmp_path}/history").collect()] == [(1, "x", 2, 2, 10, 5, 5, 50.0)]
    files.append_audit(spark.createDataFrame([("t", "1")], "tool string, id string"), f"{tmp_path}/audit")
    assert spark.read.json(f"{tmp_path}/audit").count() == 1

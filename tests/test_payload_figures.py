"""Queries whose figures SQL can't say, against plain Python over the same rows."""

from collections import Counter, defaultdict

from sparloom.kernel import delta, textalias
from sparloom.kernel.codec import Codec
from sparloom.operators.corpus import PAUSE_NS, SPAN_NS
from sparloom.plans import payload_queries as Q
from sparloom.plans import relational as R

TIERS = ("minify", "tabularize", "dictionary", "embedded", "total")


def test_gap_span_groups_of_all_events(spark, sf):
    got = defaultdict(list)
    for r in R.gap_span_groups(spark, sf).collect():
        got[r.tool].append((r.captured_at, r.sha, r.group_no))
    assert sum(map(len, got.values())) == spark.read.parquet(f"{sf}/events.parquet").count()
    for rows in got.values():
        group, start, last = -1, None, None
        for at, _, number in sorted(rows):
            if last is None or at - last >= PAUSE_NS or at - start >= SPAN_NS:
                group, start = group + 1, at
            last = at
            assert number == group


def test_tier_savings(spark, sf):
    codec, want = Codec(), defaultdict(Counter)
    for r in Q.record_payloads(spark, sf, "l_suppkey").collect():
        m = codec.measure(r.raw)
        for tool in (r.key % 3, None):
            want[tool].update({"payloads": 1, "raw_tok": m["raw_tok"]} | {f"saved_{t}": m[f"saved_{t}"] for t in TIERS})
    got = {r.tool: r for r in Q.tier_savings(spark, sf).collect()}
    assert got.keys() == want.keys()
    for tool, counts in want.items():
        assert all(got[tool][k] == n for k, n in counts.items()) and abs(got[tool].saved_pct - 100 * counts["saved_total"] / counts["raw_tok"]) < 1e-9
        assert counts["saved_total"] == sum(counts[f"saved_{t}"] for t in TIERS[:-1])


def test_cross_counter(spark, sf):
    a, b, sums = Codec(), Codec(count=lambda text: max(1, len(text.encode()) // 3)), defaultdict(lambda: [0, 0, 0, 0])
    for r in Q.record_payloads(spark, sf, "l_suppkey").collect():
        x, y = a.measure(r.raw), b.measure(r.raw)
        sums[r.key % 5] = [p + q for p, q in zip(sums[r.key % 5], (x["saved_total"], x["raw_tok"], y["saved_total"], y["raw_tok"]))]
    apart = [abs(100 * s[0] / s[1] - 100 * s[2] / s[3]) for s in sums.values()]
    got = Q.cross_counter_savings(spark, sf).first()
    assert abs(got.max_divergence - max(apart)) < 1e-9 and abs(got.mean_divergence - sum(apart) / len(apart)) < 1e-9 and got.invariant == (max(apart) <= 3)


def test_verify_summary(spark, sf):
    codec, want = Codec(), defaultdict(Counter)
    texts = [r.raw for r in Q.record_payloads(spark, sf).collect()] + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for text in texts:
        m = codec.measure(text) if text is not None else defaultdict(lambda: None)
        ok, inner = bool(m["roundtrip_ok"]), bool(m["embedded_ok"])
        want[m["shape"]].update({"payloads": 1, "lossless": ok, "embedded_ok": ok and inner, "raw_tok": m["raw_tok"] or 0})
    got = {r.shape: r for r in Q.verify_summary(spark, sf).collect()}
    assert got.keys() == want.keys() and all((got[s][k] or 0) == n for s, counts in want.items() for k, n in counts.items())


def test_text_alias_ceiling(spark, sf):
    want = defaultdict(Counter)
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        if r.text is not None:
            c = textalias.ceiling(r.text)
            want[r.lang].update({m: c[m] for m in ("raw", "line", "phrase", "block")} | {f"{m}_inflates": c[m] > c["raw"] for m in ("line", "phrase", "block")})
    got = {r.lang: r for r in Q.text_alias_ceiling(spark, sf).collect()}
    assert all(got[lang][k] == n for lang, counts in want.items() for k, n in counts.items())


def test_text_diff_sizes(spark, sf):
    import json

    want = defaultdict(Counter)
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        if r.text:
            new = f"{r.text[:500]} new words here {r.text[500:]}"
            ops = json.dumps(delta.text_encode(r.text, new), ensure_ascii=False)
            want[r.lang].update({"texts": 1, "smaller": len(ops) < len(new), "delta_chars": len(ops), "chars": len(new)})
    got = {r.lang: r for r in Q.text_diff_sizes(spark, sf).collect()}
    assert got.keys() == want.keys() and all(got[lang][k] == n for lang, counts in want.items() for k, n in counts.items())


def test_width_sweep_saves(spark):
    codec = Codec()
    for r in Q.width_payloads(spark).collect():
        m = codec.measure(r.raw)
        assert m["roundtrip_ok"] and m["saved_total"] == sum(m[f"saved_{t}"] for t in TIERS[:-1]) > 0


def test_measure_is_one_pass_of_compress():
    """The figures of a measurement are those of the texts that compress gives."""
    codec = Codec()
    for raw in ('[{"a":1,"b":"some words"},{"a":2,"b":"some words"}]', '{"x":"[{\\"a\\":1},{\\"a\\":2}]"}', "plain", "3"):
        m = codec.measure(raw)
        if m["applicable"]:
            import json

            value = json.loads(raw)
            assert m["compressed_tok"] == codec.count(codec.compress(value)) and m["embedded_tok"] == codec.count(codec.compress(value, embedded=True))
            assert m["tabular_tok"] == codec.count(codec.tabular(value))

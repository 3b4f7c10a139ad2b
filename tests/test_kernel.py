import json
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from sparloom.kernel import delta, lossy, questions, replies, textalias
from sparloom.kernel.codec import Codec, find_records, layout_of, same_mirror, shape_of
from sparloom.kernel.forms import equal, minify, parse, too_deep

C = Codec()
# Payloads as tools send them: a word list of their own, texts that look like other types, and tables with holes.
WORDS = ["depot", "lot", "qty", "sku", "seen", "notes", "geo", "~1", "__proto__", "Ünïcode", "a b", ""]
texts = st.sampled_from([*WORDS, "null", "17", "1.50", "true", "[1]", '{"qty":1}', "2024-02-30T25:61:00Z", "\u2028", "\x00"]) | st.text(st.characters(codec="utf-8"), max_size=30)
leaves = st.sampled_from([None, True, False, 0, -1, 2**53 + 1, -(2**70), 0.1, -0.0, 1e300, 5e-324]) | st.integers() | texts


@st.composite
def payload(draw, depth=3):
    """Any JSON: leaves, lists of like or unlike things, objects."""
    if not depth or draw(st.integers(0, 2)) == 0:
        return draw(leaves)
    if draw(st.booleans()):
        one = payload(depth - 1)
        return draw(st.lists(one, max_size=4)) or [draw(one)] * draw(st.integers(0, 3))
    return draw(st.dictionaries(texts, payload(depth - 1), max_size=4))


@st.composite
def table(draw):
    """Rows over common columns: each column repeats few values, counts up or holds anything; cells go missing now and then."""
    names = draw(st.lists(st.sampled_from(WORDS), min_size=1, max_size=6, unique=True))
    few = {n: draw(st.lists(payload(1), min_size=1, max_size=3)) for n in names}
    kinds = {n: draw(st.sampled_from(("few", "count", "any"))) for n in names}
    missing = draw(st.sampled_from((0, 0, 1, 5)))
    rows = []
    for i in range(draw(st.integers(0, 20))):
        row = {n: i if kinds[n] == "count" else draw(st.sampled_from(few[n]) if kinds[n] == "few" else payload(1)) for n in names}
        rows.append({n: x for n, x in row.items() if draw(st.integers(0, 9)) >= missing})
    return rows


values, records = payload(), table()


@settings(max_examples=300, deadline=None)
@given(values)
def test_any_payload_comes_back(v):
    for tiers in ({}, {"embedded": True}, {"tables": False, "embedded": True}, {"aliases": False}):
        assert C.reserved(v) or equal(C.decompress(C.compress(v, **tiers)), v)


@settings(max_examples=300, deadline=None)
@given(records)
def test_records_come_back_in_type(v):
    assert minify(C.decompress(C.compress(v))) and json.dumps(C.decompress(C.compress(v)), sort_keys=True) == json.dumps(v, sort_keys=True)


@settings(max_examples=200, deadline=None)
@given(records, records)
def test_deltas_give_back(a, b):
    d = delta.encode(a, b)
    assert d is None or equal(delta.apply(a, d), b)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=2000), st.text(max_size=2000))
def test_text_deltas_give_back(a, b):
    for x, y in ((a, b), (a, a[:100] + "new" + a[100:])):
        ops = delta.text_encode(x, y)
        assert (ops is None) == (not x) and (ops is None or delta.text_decode(x, ops) == y)


def test_density_and_sentinels():
    assert layout_of([{"a": 1}, {"b": 1}]) is None  # exactly half
    assert layout_of([{"a": 1, "b": 1}, {"a": 1}]).absent == [1]
    plan = layout_of([{"a": 1, "b": None}, {"a": 1}, {"a": 2, "b": 1}])
    assert plan.sentinel == [1]
    v = [{"a": 1, "b": None}, {"a": 1}, {"a": 2, "b": 1}]
    assert json.dumps(C.unfold(C.fold(v))) == json.dumps(v)


def test_aliases_leave_gaps_and_avoid_literals():
    v = ["~0", "a rather long repeated string"] + ["a rather long repeated string"] * 4 + ["ab", "ab"]
    data, legend = C.alias(v)
    assert "~0" not in legend and list(legend) == ["~1"] and C.expand(data, legend) == v


def test_embedded_needs_exact_bytes():
    inner = [{"id": i, "state": "running for long"} for i in range(9)]
    for text in (json.dumps(inner), json.dumps(inner, indent=2), minify(inner)):
        assert C.fold({"b": text}, embedded=True)["b"] != text and C.unfold(C.fold({"b": text}, embedded=True))["b"] == text
    for text in ('{"a": 1.50}', '{"a":1,"a":2}', " []", "[1"):
        assert C.fold(text, embedded=True) == text


def test_guards():
    deep = json.loads("[" * 201 + "]" * 201)
    assert too_deep(deep) and not too_deep(json.loads("[" * 200 + "]" * 200))
    assert C.emit("[" * 5000 + "]" * 5000)[1] == "passthrough" and C.emit("nope")[1] == "passthrough"
    assert C.emit(json.dumps({"__loom_table__": 1}))[1] == "reserved" and C.reserved(["__loom_absent__"])
    assert equal([math.nan, 1], [math.nan, True]) and not equal([1], [1, 2])
    assert parse('{"a":1,"a":2}')[1] == {"a": 2}


def test_shapes_and_paths():
    assert shape_of("x" * 2000) == "long-text" and shape_of("x") == "other"
    assert shape_of('[{"a":1},{"a":2}]') == "array-of-records" and shape_of('{\n"a":1}') == "pretty-json" and shape_of("3") == "compact-json"
    assert find_records({"r": {"s": [{"a": 1}, {"a": 2}]}}, "", True)[1] == "r.s[]" and find_records([[{"a": 1}, {"a": 2}]], "", True)[0] is None
    assert same_mirror('{"a":1,"b":2}', '{"b":2, "a":1}') and not same_mirror('{"a":1}', '{"a":true}')


def test_row_delta_refuses_reorder():
    a = [{"id": i} for i in range(4)]
    assert delta.row_delta(a, a[::-1]) is None and delta.row_delta(a, a[1:] + [{"id": 9}])["del"] == [0]
    assert delta.key_column([{"k": True}, {"k": False}], [{"k": True}, {"k": False}]) is None


def test_lossy_gates():
    v = {"result": [{"body": "x" * 300, "id": 1}, {"body": "y", "id": 2}]}
    cut = {"result[].body": {"lossy": "truncate", "max": 10}}
    out = lossy.truncate(v, cut)
    assert out["result"][0]["body"].endswith("⟨+290 chars⟩") and lossy.acceptable(v, out, cut)
    assert not lossy.acceptable(v, out | {"more": 1}, cut)
    drop = {"result[].body": {"lossy": "drop-to-retrieve"}}
    small, store = lossy.drop(v, drop, "t", C.dropped)
    assert len(store) == 1 and lossy.recoverable(v, small, drop, C.dropped, store) and not lossy.recoverable(v, small, drop, C.dropped, {})
    assert lossy.no_effect({"a": 1}, {"a": {"lossy": "truncate"}}) == ["a"]
    assert lossy.truncate(v, {"result[].body": {"lossy": "truncate", "critical": True}}) == v


def test_fences():
    text = "a\n````py\n```\nx\n````\nb ``` c\n~~~\nopen"
    spans = lossy.fences(text)
    assert [text[a:b] for a, b in spans] == ["````py\n```\nx\n````\n", "~~~\nopen"]
    big = "p\n```\n" + "z" * 500 + "\n```\nq"
    out, store = lossy.drop_blocks(big, "t", C.dropped)
    assert len(out) < 120 and lossy.restore_blocks(out, C.dropped, store) == big


def test_questions_and_scores():
    v = [{"id": i, "status": "a long state name here", "n": i * 2, "o": {"x": [1, i % 2]}} for i in range(10)]
    found = {q.qid: q for q in questions.questions(v)}
    assert found["count"].expected == 10 and found["aggregate"].expected == 18 and found["lookup"].transform == "table+dict" and "deref" in found
    assert questions.questions({"a": 1, "b": "x", "c": 2.5})[0].expected == 3 and questions.questions(3) == []
    assert replies.score("count", 6, "there are 6 records") and not replies.score("count", 6, "v6.1")
    assert replies.score("enumerate", [1, 2], "[1, 2]") and replies.score("deref", {"a": 1}, 'is {"a": 1}.') and replies.score("lookup", "X", '"x"')
    assert replies.score("sole_number", 3, "'3'") and not replies.score("sole_number", 3, "3 of 4")
    assert [q.qid for q in questions.text_questions("a\nb\nc")] == ["line-count", "last-line", "mid-line"]


def test_scores_by_kind():
    say = replies.score
    assert say("enumerate", [], "[]") and not say("enumerate", [], "") and say("enumerate", ["a", "b"], "a\n'b',") and not say("enumerate", ["a", "b"], "[b, a]")
    assert say("aggregate", 2.5, "it is 2.5.") and say("lookup", 17, '"17"') and not say("lookup", 17, "x17") and say("lookup", True, "TRUE")
    assert say("deref", [1, {"a": 2}], 'so: [1, {"a": 2}]') is False and say("deref", {"a": [2]}, 'so {"a": [2]} it is') and not say("deref", {}, "no json")
    assert replies.score_form("count", 3, ["3", None, "4", "there are 3"]) == (2, 4) and replies.score_form("count", 3, "3") == (1, 1) and replies.score_form("count", 3, []) == (0, 0)


def test_grouped_records_are_asked_about_by_label():
    own = {"files": {"a.py": {"n": 1}, "b.py": {"symbols": [{"sym": "f", "line": 3}, {"sym": "g", "line": 9, "doc": "x"}]}}}
    found = questions.questions(own)
    assert [(q.qid, q.transform, q.expected) for q in found] == [("nested-count", 'nested:files["b.py"]', 2), ("nested-enumerate", 'nested:files["b.py"]', ["f", "g"]), ("nested-aggregate", 'nested:files["b.py"]', 9)]
    assert questions.questions({"r": [{"a": 1}, {"a": 2, "b": 3}]})[0].transform == "nested:r" and questions.questions({"r": [{"a": 1}, {"a": 2}]})[0].transform == "table"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["the same line again", "a phrase of words", "x", "", "§ sign", "«0»"]), max_size=40).map("\n".join), st.sampled_from(("line", "phrase", "block")))
def test_aliases_come_back(text, mode):
    coded, legend = textalias.encode(text, mode)
    assert textalias.decode(coded, legend) == text and all(k not in text for k in legend)


def test_aliases_pay_and_bounds_are_counted():
    text = "\n".join(["a long line that comes again and again, word for word"] * 9 + ["once only"])
    coded, legend = textalias.encode(text, "line")
    assert len(coded) < len(text) / 2 and list(legend.values()) == ["a long line that comes again and again, word for word\n"]
    found = textalias.ceiling(text)
    assert found["line"] < found["raw"] and found["no_free_sigil"] == found["aliases_bound"] == 0
    assert textalias.ceiling("".join(textalias.SIGILS) + text)["no_free_sigil"] == 3


def test_fences_against_a_line_by_line_reading():
    rng = __import__("random").Random(4)
    for _ in range(2000):
        text = "".join(rng.choice(["```", "````", "~~~", "~~~~ x", " ```py", "``` `", "a", "", "  ~~~  ", "``", "```\r"]) + rng.choice(["\n", "\n", "\r\n", ""]) for _ in range(rng.randrange(9)))
        spans = lossy.fences(text)
        edges = [0, *(x for span in spans for x in span), len(text)]
        assert edges == sorted(edges) and all(text[a:b].lstrip()[:3] in ("```", "~~~") for a, b in spans)
        inside = [text[a:b].splitlines() for a, b in spans]
        for lines, (_, b) in zip(inside, spans):
            sign = lines[0].lstrip()[0]
            run = len(lines[0].lstrip()) - len(lines[0].lstrip().lstrip(sign))
            closes = [bool(x.strip()) and set(x.strip()) == {sign} and len(x.strip()) >= run for x in lines[1:]]
            assert not any(closes[:-1]) and (b == len(text) or closes[-1])


def test_measure_telescopes():
    m = C.measure(json.dumps([{"id": i, "state": "quite the same"} for i in range(20)], indent=1))
    assert m["saved_total"] == sum(m[f"saved_{t}"] for t in ("minify", "tabularize", "dictionary", "embedded")) > 0


@settings(max_examples=300, deadline=None)
@given(values | records)
def test_early_judgements_are_those_of_the_walk(v):
    """Aliasing given up early would have named nothing, and a text that can spell no reserved name holds none."""
    for folded in (v, C.fold(v), C.fold(v, embedded=True)):
        assert not C._hopeless(folded, minify(folded)) or C.alias(folded) == (folded, {})
    for raw in (minify(v), json.dumps(v)):
        assert C.reserved_in(raw, v) == C.reserved(v)


def test_escaped_reserved_names_are_seen():
    raw = json.dumps({"__loom_table__": 1}).replace("_", "\\u005f")
    assert C.emit(raw) == (raw, "reserved") and C.join_blocks([raw, "{}"])[1] == "marker"
    assert C.measure('["\\u007b\\"id\\":\\"' + "a long text " * 30 + '\\"}"]')["embedded_ok"]
    odd = Codec(prefix="a/b")
    assert odd.emit('{"__a\\/b_table__":1}')[1] == "reserved"


def test_few_encoders_are_made(monkeypatch):
    """A payload is written by encoders that exist, not by one made for each value."""
    made = []
    init = json.JSONEncoder.__init__
    monkeypatch.setattr(json.JSONEncoder, "__init__", lambda self, **kw: (made.append(1), init(self, **kw))[1])
    C.measure(json.dumps([{"id": i, "flag": "A", "body": '[{"id":1}]'} for i in range(50)]))
    assert not made

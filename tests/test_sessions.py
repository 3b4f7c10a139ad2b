"""The composed session machine: stream against fold, every path gives its originals back, and resets."""

import json

from sparloom.kernel import delta
from sparloom.kernel.codec import Codec
from sparloom.kernel.forms import equal, parse
from sparloom.plans import accounts
from sparloom.streaming import pipeline, run

C = Codec()


def client(rows, sent):
    """What a client that follows the wire rebuilds: blocks of each result, by seq."""
    base, texts, out = {}, {}, {}
    for seq in sorted(sent):
        r = sent[seq]
        blocks = json.loads(r.emitted or "[]")
        if r.path == "untracked":
            out[seq] = blocks
            continue
        if r.path in ("single", "joined"):
            [text] = blocks
            value = delta.apply(base[r.tool], json.loads(text)) if r.reason == "emitted" else C.decompress(text)
            base[r.tool] = value
            out[seq] = value
        elif r.path == "text":
            [text] = blocks
            texts[r.tool] = delta.text_decode(texts[r.tool], json.loads(text)["ops"]) if r.reason == "emitted" else text
            base.pop(r.tool, None)
            out[seq] = texts[r.tool]
        else:
            base.pop(r.tool, None), texts.pop(r.tool, None)
            out[seq] = [C.decompress(b) if parse(b)[0] else b for b in blocks]
    return out


def test_stream_equals_fold_and_originals_come_back(spark, sf):
    rows = accounts.session_rows(spark, sf).collect()
    fold = run.fold(accounts.session_rows(spark, sf), pipeline.Replacing, "session").collect()
    stream = accounts._streamed(spark, accounts.session_rows(spark, sf), pipeline.Replacing, "session").collect()
    assert sorted(map(repr, fold)) == sorted(map(repr, stream))
    assert {r.path for r in fold} == {"untracked", "single", "joined", "partial", "text", "mirror"} and {"emitted", "no_prior"} <= {r.reason for r in fold}
    for session in {r.session for r in rows}:
        sent = {r.seq: r for r in fold if r.session == session}
        back = client(rows, sent)
        for r in (x for x in rows if x.session == session and x.dir == "response"):
            blocks, got = json.loads(r.blocks), sent[r.seq]
            whole = [parse(b)[1] if parse(b)[0] else b for b in blocks]
            if got.path == "mirror":
                assert got.emitted == "[]" and equal(C.decompress(got.structured), whole[0])
            elif got.path == "untracked":
                assert back[r.seq] == blocks and got.structured == r.structured
            elif got.path == "partial":
                assert equal(back[r.seq], [whole[:2], whole[2]])
            else:
                assert equal(back[r.seq], whole if got.path == "joined" else whole[0])


def row(seq, **more):
    return {"session": "s", "seq": seq, "id": str(seq), "tool": "t", "args": "", "client": "desk", "structured": None, "error": False, "blocks": None} | more


def ask(machine, seq, *blocks, **more):
    machine.step(row(seq, dir="request"))
    return machine.step(row(seq, dir="response", blocks=json.dumps(blocks), **more))[0]


def test_reset_and_refusals():
    machine = pipeline.Replacing()
    big = json.dumps([{"id": i, "state": "quite the same words"} for i in range(30)])
    assert ask(machine, 1, big)[5] == "no_prior" and ask(machine, 2, big)[5] == "emitted"
    machine.step(row(3, dir="initialize"))
    assert machine.generation == 1 and machine.client == "desk" and ask(machine, 4, big)[5] == "no_prior"
    one = '{"a":1}'
    assert ask(machine, 5, one, structured='{"a": 1}')[4] == "mirror"
    # no mirror: an error, two blocks, another value
    assert ask(machine, 6, one, structured='{"a": 1}', error=True)[4] == "single"
    assert ask(machine, 7, one, one, structured='{"a": 1}')[4] == "joined" and ask(machine, 8, one, structured='{"a": 2}')[4] == "single"
    again = pipeline.Replacing(json.loads(json.dumps(machine.state())))
    assert again.state() == machine.state()

    class Off(pipeline.Replacing):
        tiers = False

    assert ask(Off(), 1, one, structured=one)[4:6] == ("off", "no tiers")


def test_structured_modes():
    text = json.dumps([{"id": i, "state": "quite the same words"} for i in range(30)])
    assert pipeline.structured_mode("auto", "desk", frozenset({"desk"})) == "compress" and pipeline.structured_mode("auto", None, frozenset({"desk"})) == "leave"
    assert pipeline.compress_structured(text, "leave", C) == (text, False) and pipeline.compress_structured(None, "compress", C) == (None, False)
    out, rewrote = pipeline.compress_structured(text, "compress", C)
    assert rewrote and len(out) < len(text) and equal(C.decompress(out), json.loads(text))


def test_text_chain_gives_texts_back(spark, sf):
    texts = {(str(r.conv_id), r.turn): "shared head of every turn\n" * 30 + r.text for r in spark.read.parquet(f"{sf}/conversations.parquet").collect() if r.text is not None}
    base, seen = {}, set()
    for r in sorted(accounts.text_chain(spark, sf).collect(), key=lambda r: (r.session, r.seq)):
        base[r.session] = delta.text_decode(base[r.session], json.loads(r.emitted)["ops"]) if r.reason == "emitted" else r.emitted
        assert base[r.session] == texts[r.session, r.seq]
        seen.add(r.reason)
    assert {"emitted", "no_prior", "keyframe"} <= seen

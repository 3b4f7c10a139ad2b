"""The rows of a key of a stream are not held together, and come in order all the same."""

import random
import weakref

import pandas as pd
import pytest

from sparloom.streaming import machines, run


class Value:
    held = None

    def get(self):
        return self.held

    def update(self, row):
        self.held = row


def processor():
    made = run.MachineProcessor(machines.DropStore)
    made.value = Value()
    return made


def rows(seqs):
    return pd.DataFrame({"session": "s", "seq": seqs, "handle": [f"h{n % 5}" for n in seqs], "op": ["reset" if n % 50 == 0 else "put" if n % 3 else "get" for n in seqs], "value": [None if n % 4 else "v" * 100 for n in seqs]})


def test_a_key_is_not_held_whole(monkeypatch):
    monkeypatch.setattr("sparloom.streaming.ordered.ROOM", 12_000)
    monkeypatch.setattr("sparloom.streaming.ordered.RUNS", 3)
    seqs = list(range(3000))
    random.Random(3).shuffle(seqs)
    alive, most = weakref.WeakSet(), 0

    class Part(pd.DataFrame):
        __hash__ = object.__hash__

    def parts():
        nonlocal most
        for start in range(0, len(seqs), 20):
            part = Part(rows(seqs[start : start + 20]))
            alive.add(part)
            yield part
            del part
            most = max(most, len(alive))

    got = pd.concat(list(processor().handleInputRows(("s",), parts(), None)))
    want = pd.concat(list(processor().handleInputRows(("s",), iter([rows(sorted(seqs))]), None)))
    assert got.values.tolist() == want.values.tolist() and got["seq"].tolist() == list(range(3000))
    assert most < 20


def test_runs_keep_ties_and_put_nulls_last(monkeypatch):
    from sparloom.streaming import ordered

    numbers = random.Random(5)
    parts = [pd.DataFrame({"seq": [numbers.choice([None, 1, 2, 3, 2**53 + 1]) for _ in range(7)], "n": range(at, at + 7), "text": [None, "ä" * 50, "", "x", "\n", "\0", "y"]}, dtype=object) for at in range(0, 700, 7)]
    whole = [r for part in parts for r in part.to_dict("records")]
    want = sorted(whole, key=lambda r: (r["seq"] is None, r["seq"] or 0))
    for room, runs in ((1 << 30, 64), (1, 2), (1, 3), (3000, 4), (3000, 64)):
        monkeypatch.setattr(ordered, "ROOM", room)
        monkeypatch.setattr(ordered, "RUNS", runs)
        assert list(ordered.in_order(iter(parts), "seq")) == want


def test_a_file_cut_short_is_an_error():
    from sparloom.streaming import ordered

    written = ordered._write(iter([(n, "x" * n) for n in range(500)]), 0, 7)
    written.file.truncate(200)
    with pytest.raises(EOFError):
        list(ordered._read(written))


def test_large_rows_come_out_in_small_frames():
    class Echo:
        schema = "session string, seq long, text string"

        def __init__(self, state=None):
            pass

        def state(self):
            return {}

        def step(self, row):
            return [(row["session"], row["seq"], row["text"])]

    made = run.MachineProcessor(Echo)
    made.value = Value()
    frames = list(made.handleInputRows(("s",), iter([pd.DataFrame({"session": "s", "seq": range(40), "text": "x" * 1_000_000})]), None))
    assert pd.concat(frames)["seq"].tolist() == list(range(40)) and max(map(len, frames)) < 20

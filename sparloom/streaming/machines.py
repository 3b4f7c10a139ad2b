"""Session state as small machines: plain values in, rows out, state as JSON.

The same machine runs inside a streaming operator (its state in the state store)
and in a batch fold, so the two can be held against each other.
"""

from __future__ import annotations

import hashlib
from typing import Any

from ..kernel import delta
from ..kernel.codec import Codec
from ..kernel.forms import canonical, chars4, minify, parse

# Fixed values
PENDING, STORE_COUNT, STORE_BYTES, KEYFRAME = 1024, 512, 8 << 20, 5


class Correlator:
    """Requests meet their responses; the oldest go when too many wait.  Keyed by session."""

    schema = "session string, seq long, id string, tool string, outcome string"

    def __init__(self, state: dict | None = None):
        self.pending: dict[str, list] = (state or {}).get("pending", {})

    def state(self) -> dict:
        return {"pending": self.pending}

    def step(self, row: dict) -> list[tuple]:
        key, own = row["id"], (row["session"], row["seq"], row["id"])
        if row["dir"] == "reset":
            self.pending = {}
            return []
        if row["dir"] == "request":
            self.pending.pop(key, None)
            self.pending[key] = [row["tool"], hashlib.sha1((row.get("args") or "").encode()).hexdigest()[:8]]
            if len(self.pending) > PENDING:
                self.pending.pop(next(iter(self.pending)))
            return []
        found = self.pending.pop(key, None)  # also on an error reply
        return [(*own, found[0] if found else None, "error" if row["dir"] == "error" else "matched" if found else "unmatched")]


class DiffChain:
    """Full result or delta on the one before, re-anchored after some deltas.  Keyed by session and tool."""

    schema = "session string, tool string, seq long, reason string, emitted string"

    def __init__(self, state: dict | None = None, keyframe: int = KEYFRAME, codec: Codec | None = None):
        s = state or {}
        self.base, self.args, self.joined, self.since = s.get("base"), s.get("args"), s.get("joined"), s.get("since", 0)
        self.keyframe, self.codec = keyframe, codec or Codec()
        self.value = None  # the base as parsed, where this machine has parsed it

    def state(self) -> dict:
        return {"base": self.base, "args": self.args, "joined": self.joined, "since": self.since}

    def step(self, row: dict) -> list[tuple]:
        own = (row["session"], row["tool"], row["seq"])
        ok, value = parse(row["raw"])
        if not ok or self.codec.reserved_in(row["raw"], value):
            self.base, self.value, self.since = None, None, 0  # the next one has nothing to stand on
            return [(*own, "skipped", row["raw"])]
        full, joined, reason = self.codec.compress(value), bool(row.get("joined")), "no_prior"
        out = full
        if self.base is not None and self.joined != joined:
            reason = "reanchor"
        elif self.base is not None and 0 < self.keyframe <= self.since:
            reason = "keyframe"
        elif self.base is not None:
            prior = self.value if self.value is not None else parse(self.base)[1]
            text = delta.wire(prior, value, self.codec.diff, row["tool"])
            if text is not None and chars4(text) < chars4(full):
                out, reason = text, "emitted"
            else:
                reason = "not_smaller_same_args" if self.args == row.get("args") else "not_smaller_diff_args"
        self.since = self.since + 1 if reason == "emitted" else 0
        self.base, self.value, self.args, self.joined = row["raw"], value, row.get("args"), joined
        return [(*own, reason, out)]


class TextChain:
    """The same for text that is no JSON, by chunks."""

    schema = DiffChain.schema

    def __init__(self, state: dict | None = None, keyframe: int = KEYFRAME):
        s = state or {}
        self.base, self.since, self.keyframe = s.get("base"), s.get("since", 0), keyframe

    def state(self) -> dict:
        return {"base": self.base, "since": self.since}

    def step(self, row: dict) -> list[tuple]:
        raw, reason, out = row["raw"], "no_prior", row["raw"]
        if self.base is not None and 0 < self.keyframe <= self.since:
            reason = "keyframe"
        elif self.base is not None:
            ops = delta.text_encode(self.base, raw)
            text = minify({"ops": ops}) if ops is not None else None
            reason = "emitted" if text is not None and chars4(text) < chars4(raw) else "not_smaller_same_args"
            out = text if reason == "emitted" else raw
        self.since = self.since + 1 if reason == "emitted" else 0
        self.base = raw
        return [(row["session"], row["tool"], row["seq"], reason, out)]


class DropStore:
    """Handles and their values, least recently used first out, by count and characters.  Keyed by session."""

    schema = "session string, seq long, handle string, outcome string, held long"

    def __init__(self, state: dict | None = None, most: int = STORE_COUNT, room: int = STORE_BYTES):
        self.held: dict[str, str] = (state or {}).get("held", {})
        self.most, self.room = most, room

    def state(self) -> dict:
        return {"held": self.held}

    def step(self, row: dict) -> list[tuple]:
        own, name = (row["session"], row["seq"], row["handle"]), row["handle"]
        if row["op"] == "reset":
            self.held = {}
            return [(*own, "cleared", 0)]
        if row["op"] == "get":
            value = self.held.pop(name, None)
            if value is not None:
                self.held[name] = value  # reading makes it recent
            return [(*own, "hit" if value is not None else "miss", len(self.held))]
        self.held.pop(name, None)
        self.held[name] = row["value"] or ""
        while len(self.held) > self.most or sum(map(len, self.held.values())) > self.room and len(self.held) > 1:
            self.held.pop(next(iter(self.held)))
        return [(*own, "stored", len(self.held))]


class LazyPrimer:
    """Attach once, to the first result that carries a marker and no structured part; say once if that can't be."""

    schema = "session string, seq long, outcome string"

    def __init__(self, state: dict | None = None, mark: str = '"__loom_'):
        s = state or {}
        self.sent, self.declined, self.mark = s.get("sent", False), s.get("declined", False), mark

    def state(self) -> dict:
        return {"sent": self.sent, "declined": self.declined}

    def step(self, row: dict) -> list[tuple]:
        if row.get("dir") == "reset":
            self.sent = self.declined = False
        elif not self.sent and self.mark in (row["raw"] or ""):
            if not row.get("structured"):
                self.sent = True
                return [(row["session"], row["seq"], "attached")]
            if not self.declined:
                self.declined = True
                return [(row["session"], row["seq"], "suppressed")]
        return []


def digest(value: Any) -> str:
    return hashlib.sha1(canonical(value).encode()).hexdigest()[:8]

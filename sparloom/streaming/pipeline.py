"""The whole way of a tool result through a session: one machine of the smaller ones.

A result meets its request; a block that only mirrors the typed field goes; blocks
that are all objects become one array, adjacent objects among others too; one JSON block
takes the delta chain, one text block the text chain; the typed field is packed
where the client may have it so; the primer goes out with the first packed result.  What has
no request is forwarded as it came.  ``initialize`` clears all of it.
"""

from __future__ import annotations

import json
from itertools import groupby

from ..kernel.codec import Codec, same_mirror
from ..kernel.forms import minify, parse
from .machines import Correlator, DiffChain, LazyPrimer, TextChain

# The settings that rewrite the typed field.
REWRITING = frozenset({"compress", "replace"})


def structured_mode(mode: str, client: str | None, packed_clients: frozenset[str]) -> str:
    """``auto`` packs for the clients named by the deployment only; an unknown client keeps the field as it is."""
    return mode if mode != "auto" else "compress" if client in packed_clients else "leave"


def compress_structured(text: str | None, mode: str, codec: Codec) -> tuple[str | None, bool]:
    """(typed field as sent, whether it was rewritten)."""
    if text is None or mode not in REWRITING:
        return text, False
    out, _ = codec.emit(text)
    return (out, True) if out != text and parse(out)[0] else (text, False)


class Transform:
    """Rows: dir (initialize, request, response), id, tool, args, client, blocks (JSON array of texts), structured, error."""

    schema = "session string, seq long, id string, tool string, path string, reason string, emitted string, structured string, primer string"
    mode = "auto"
    tiers = True
    packed_clients: frozenset[str] = frozenset()

    def __init__(self, state: dict | None = None, codec: Codec | None = None):
        s = state or {}
        self.codec = codec or Codec()
        self.calls = Correlator(s.get("calls"))
        self.chains: dict[str, dict] = s.get("chains", {})
        self.texts: dict[str, dict] = s.get("texts", {})
        self.primer = LazyPrimer(s.get("primer"))
        self.client = s.get("client")
        self.generation = s.get("generation", 0)

    def state(self) -> dict:
        return {"calls": self.calls.state(), "chains": self.chains, "texts": self.texts, "primer": self.primer.state(), "client": self.client, "generation": self.generation}

    def forget(self, tool: str) -> None:
        """The next result of a tool has nothing to stand on."""
        self.chains.pop(tool, None)
        self.texts.pop(tool, None)

    def step(self, row: dict) -> list[tuple]:
        if row["dir"] == "initialize":
            generation = self.generation + 1
            self.__init__(None, self.codec)
            self.client, self.generation = row.get("client"), generation
            return []
        if row["dir"] == "request":
            self.calls.step(row)
            return []
        known = self.calls.pending.get(row["id"])
        self.calls.step(row)
        blocks = json.loads(row["blocks"] or "[]")
        own = (row["session"], row["seq"], row["id"])
        if known is None:
            return [(*own, None, "untracked", "as it came", row["blocks"], row.get("structured"), None)]
        tool, args = known
        mode = structured_mode(self.mode, self.client, self.packed_clients)
        path, reason, out = self.blocks(row | {"tool": tool, "args": args}, blocks, mode)
        typed, _ = compress_structured(row.get("structured"), mode if self.tiers else "leave", self.codec)
        said = self.primer.step({"session": row["session"], "seq": row["seq"], "dir": "response", "raw": "\n".join(out), "structured": row.get("structured")})
        return [(*own, tool, path, reason, json.dumps(out, ensure_ascii=False), typed, said[0][2] if said else None)]

    def blocks(self, row: dict, blocks: list[str], mode: str) -> tuple[str, str, list[str]]:
        """(way taken, reason, blocks sent)."""
        tool, structured = row["tool"], row.get("structured")
        if not self.tiers:
            return "off", "no tiers", blocks
        if mode == "replace" and not row.get("error") and len(blocks) == 1 and structured is not None and same_mirror(blocks[0], structured):
            self.forget(tool)
            return "mirror", "mirror_dropped", []
        if len(blocks) == 1:
            ok = parse(blocks[0])[0]
            reason, text = self.chained(row, blocks[0], False) if ok else self.texted(row, blocks[0])
            return "single" if ok else "text", reason, [text]
        joined, why = self.codec.join_blocks(blocks)
        if joined is not None:
            reason, text = self.chained(row, joined, True)
            return "joined", reason, [text]
        self.forget(tool)
        runs = [(is_object, list(run)) for is_object, run in groupby(blocks, lambda b: isinstance(parse(b)[1], dict))]
        out, partial = [], False
        for is_object, run in runs:
            whole = self.codec.join_blocks(run)[0] if is_object and len(run) > 1 else None
            partial |= whole is not None
            out += [self.codec.emit(whole)[0]] if whole is not None else [self.codec.emit(b)[0] for b in run]
        return ("partial" if partial else "blocks"), why, out

    def chained(self, row: dict, raw: str, joined: bool) -> tuple[str, str]:
        chain = DiffChain(self.chains.get(row["tool"]), codec=self.codec)
        [(*_, reason, text)] = chain.step(row | {"raw": raw, "joined": joined})
        self.chains[row["tool"]] = chain.state()
        return reason, text

    def texted(self, row: dict, raw: str) -> tuple[str, str]:
        """Text has a base of its own, and leaves the JSON chain without one."""
        self.chains.pop(row["tool"], None)
        chain = TextChain(self.texts.get(row["tool"]))
        [(*_, reason, text)] = chain.step(row | {"raw": raw})
        self.texts[row["tool"]] = chain.state()
        return reason, text


class Replacing(Transform):
    """For rules that let a mirrored typed field stand for its block."""

    mode = "replace"

"""Lossless codec: record lists as tables, repeated values as aliases, embedded JSON.

Reserved keys carry a prefix, so a deployment may choose its own wire names.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import chain
from typing import Any

from .forms import FORMS, SCALARS, WRITE, canonical, chars4, children, equal, minify, parse, too_deep

__all__ = ["Codec", "Layout", "find_records", "layout_of", "shape_of"]

LONG_TEXT = 2000
#: Costs of so many texts, each of at most so many characters, are kept.
KNOWN_COSTS, SHORT_TEXT = 4096, 24
DIGITS = "0123456789abcdefghijklmnopqrstuvwxyz"


@dataclass
class Layout:
    """How a record list is laid out: columns, which may be absent, which also hold nulls."""

    cols: list[str]
    absent: list[int] = field(default_factory=list)
    sentinel: list[int] = field(default_factory=list)
    aligned: bool = False  # every record has these columns, in this order


def layout_of(records: Any) -> Layout | None:
    """The layout of two or more objects that fill over half of their common table, else None."""
    if not isinstance(records, list) or len(records) < 2 or not all(isinstance(r, dict) for r in records):
        return None
    if len(set(map(tuple, records))) == 1:  # the same columns everywhere
        return Layout(list(records[0]), aligned=True)
    seen: dict[str, list[int]] = {}  # column -> [rows with it, nulls in it]
    for record in records:
        for key, value in record.items():
            tally = seen.setdefault(key, [0, 0])
            tally[0] += 1
            tally[1] += value is None
    rows = len(records)
    holes = {i: nulls for i, (have, nulls) in enumerate(seen.values()) if have < rows}
    if holes and 2 * sum(have for have, _ in seen.values()) <= rows * len(seen):
        return None
    return Layout(list(seen), list(holes), [i for i, nulls in holes.items() if nulls])


def find_records(value: Any, path: str | None = "", keys_only: bool = False) -> tuple[list | None, str | None]:
    """The first list a table would hold, depth first, and its field path where keys alone lead there."""
    if isinstance(value, list):
        if layout_of(value) is not None:
            return value, None if path is None else f"{path}[]"
        if keys_only:
            return None, None
        steps = ((None, x) for x in value)
    elif isinstance(value, dict):
        steps = (((f"{path}.{k}" if path else str(k)) if path is not None else None, v) for k, v in value.items())
    else:
        return None, None
    for step, child in steps:
        found, where = find_records(child, step, keys_only)
        if found is not None:
            return found, where
    return None, None


def shape_of(raw: str) -> str:
    """long-text or other (not JSON), array-of-records, pretty-json or compact-json."""
    return _shape(raw, *parse(raw))


def _shape(raw: str, ok: bool, value: Any) -> str:
    if not ok and value is None:
        return "long-text" if len(raw) >= LONG_TEXT else "other"
    if ok and find_records(value)[0] is not None:
        return "array-of-records"
    return "pretty-json" if isinstance(value, (dict, list)) and "\n" in raw.strip() else "compact-json"


def _base36(n: int) -> str:
    text = ""
    while True:
        n, digit = divmod(n, 36)
        text = DIGITS[digit] + text
        if not n:
            return text


class Codec:
    """Tiers over one payload.  ``count`` is the token counter that decides what pays."""

    def __init__(self, prefix: str = "loom", count: Callable[[str], int] = chars4):
        self.table, self.dict, self.diff, self.json, self.dropped = (f"__{prefix}_{n}__" for n in ("table", "dict", "diff", "json", "dropped"))
        self.hole = f"__{prefix}_absent__"
        self.keys = frozenset((self.table, self.dict, self.diff, self.json, self.dropped))
        self.count = count
        self._costs: dict[str, int] = {}
        self.stem, self.short = f"__{prefix}_", not set(prefix).isdisjoint('"\\/\b\f\n\r\t')

    def cost(self, text: str) -> int:
        """Tokens of a string as a JSON value."""
        if len(text) > SHORT_TEXT:
            return self.count(minify(text))
        known = self._costs.get(text)
        if known is None:
            if len(self._costs) >= KNOWN_COSTS:
                self._costs.clear()
            known = self._costs[text] = self.count(minify(text))
        return known

    def reserved(self, value: Any) -> bool:
        """Does the payload itself use a reserved key or the hole's text?"""
        work = [value]
        while work:
            x = work.pop()
            if isinstance(x, dict) and not self.keys.isdisjoint(x) or x == self.hole and isinstance(x, str):
                return True
            work += children(x)
        return False

    def reserved_in(self, raw: str, value: Any) -> bool:
        """The same of a value and its text: few texts can spell such a name, plainly or by escapes, so few values are walked."""
        return (self.stem in raw or "\\u" in raw or self.short and "\\" in raw) and self.reserved(value)

    # --- tables and embedded documents ---

    def _settled(self, values, embedded: bool) -> bool:
        """Are they scalars that folding leaves as they are?"""
        return SCALARS.issuperset(map(type, values)) and not (embedded and any(type(x) is str and x.startswith(("{", "[")) for x in values))

    def fold(self, value: Any, tables: bool = True, embedded: bool = False) -> Any:
        if isinstance(value, str):
            return self._embedded(value, tables) if embedded else value
        if isinstance(value, dict):
            return dict(value) if self._settled(value.values(), embedded) else {k: self.fold(v, tables, embedded) for k, v in value.items()}
        if not isinstance(value, list):
            return value
        if self._settled(value, embedded):
            return list(value)
        plan = layout_of(value) if tables else None
        if plan is None:
            return [self.fold(v, tables, embedded) for v in value]
        head, rows = self._rows(value, plan, embedded)
        return {self.table: 1, "n": len(rows), "cols": head.pop("cols"), "rows": rows, **head}

    def _rows(self, records: list[dict], plan: Layout, embedded: bool) -> tuple[dict, list[list]]:
        """(header, positional rows); a column of records keeps its own header once."""
        if plan.aligned and self._settled([*chain.from_iterable(map(dict.values, records))], embedded):
            return {"cols": plan.cols}, [[*r.values()] for r in records]
        columns, nested = [], {}
        for i, key in enumerate(plan.cols):
            if i in plan.sentinel:
                columns.append([self.fold(r[key], True, embedded) if key in r else self.hole for r in records])
                continue
            cells = [r.get(key) for r in records]
            if self._settled(cells, embedded):
                columns.append(cells)
                continue
            inner = layout_of(cells)
            if inner is None:
                columns.append([self.fold(x, True, embedded) for x in cells])
            else:
                nested[key], rows = self._rows(cells, inner, embedded)
                columns.append(rows)
        head: dict[str, Any] = {"cols": plan.cols}
        head |= {"subcols": nested} if nested else {}
        head |= {"absent_cols": plan.absent} if plan.absent else {}
        head |= {"sentinel_cols": plan.sentinel} if plan.sentinel else {}
        return head, [list(row) for row in zip(*columns)] if columns else [[] for _ in records]

    def _embedded(self, text: str, tables: bool) -> Any:
        """A string that is exactly one serialization of a document, where folding it pays."""
        if not text.startswith(("{", "[")):
            return text
        ok, value = parse(text)
        if not ok or not isinstance(value, (dict, list)) or self.reserved_in(text, value):
            return text
        tight = (": " if isinstance(value, dict) else ", ") not in text and len(value) > isinstance(value, list)
        for name, write in WRITE.items():
            # text without that sign is none of the forms that part with a blank
            if not (tight and name in "pP") and write(value) == text:
                wrapped = {self.json: 1, "f": name, "v": self.fold(value, tables, True)}
                return wrapped if self.count(minify(wrapped)) < self.cost(text) else text
        return text

    def unfold(self, value: Any) -> Any:
        if isinstance(value, list):
            return list(value) if SCALARS.issuperset(map(type, value)) else [self.unfold(v) for v in value]
        if not isinstance(value, dict):
            return value
        if value.get(self.table) == 1 and "cols" in value and "rows" in value:
            if value.get("subcols") or value.get("absent_cols") or value.get("sentinel_cols"):
                return [self._record(row, value) for row in value["rows"]]
            cols, rows = value["cols"], value["rows"]
            if {*map(len, rows)} == {len(cols)} and SCALARS.issuperset(map(type, chain.from_iterable(rows))):
                return [dict(zip(cols, row)) for row in rows]
            return [dict(zip(cols, row if SCALARS.issuperset(map(type, row)) else map(self.unfold, row), strict=True)) for row in rows]
        if value.get(self.json) == 1 and "f" in value and "v" in value:
            if value["f"] not in FORMS:
                raise ValueError(f"unknown form of an embedded document: {value['f']!r}")
            return WRITE[value["f"]](self.unfold(value["v"]))
        return {k: self.unfold(v) for k, v in value.items()}

    def _record(self, row: list, head: dict) -> dict:
        nested, absent, sentinel = head.get("subcols", {}), set(head.get("absent_cols", ())), set(head.get("sentinel_cols", ()))
        record = {}
        for i, (key, cell) in enumerate(zip(head["cols"], row, strict=True)):
            missing = (cell == self.hole) if i in sentinel else (cell is None and i in absent)
            if not missing:
                record[key] = self._record(cell, nested[key]) if key in nested else self.unfold(cell)
        return record

    # --- aliases ---

    def _canonical_parts(self, value: Any, into: dict[int, str], flat: set[int]) -> str:
        """The compact text of every container, built from its children's; ``flat`` gets those that hold no other."""
        inner = value.values() if isinstance(value, dict) else value
        if SCALARS.issuperset(map(type, inner)):
            text = minify(value)
            flat.add(id(value))
        else:
            texts = [minify(v) if type(v) in SCALARS else self._canonical_parts(v, into, flat) for v in inner]
            text = "{" + ",".join([f"{minify(k)}:{t}" for k, t in zip(value, texts)]) + "}" if isinstance(value, dict) else "[" + ",".join(texts) + "]"
        into[id(value)] = text
        return text

    def _hopeless(self, value: Any, text: str) -> bool:
        """Can no alias pay, as the value's strings and innermost containers show?

        What repeats a container repeats those in it, so equal ones are found without their texts
        (except for NaN, which equals nothing).  No name is taken to be cheaper than the cheapest of one digit.
        """
        if not isinstance(value, (dict, list)) or "NaN" in text or '"~' in text:
            return False
        trees, texts, stack = [], [], [value]
        while stack:
            x = stack.pop()
            inner = x.values() if isinstance(x, dict) else x
            if SCALARS.issuperset(map(type, inner)):
                trees.append(tuple(x.items() if isinstance(x, dict) else x))
            else:
                stack += [v for v in inner if isinstance(v, (dict, list))]
            texts += [v for v in inner if type(v) is str]
        if len(set(trees)) < len(trees):
            return False
        repeats = [(x, n) for x, n in Counter(texts).items() if n > 1]
        if len(repeats) > len(DIGITS):
            return False
        least = min([self.cost("~" + d) for d in DIGITS[: len(repeats)]], default=0)
        return not any(n * price > n * least + least + price for price, n in ((self.cost(x), n) for x, n in repeats))

    def alias(self, value: Any) -> tuple[Any, dict[str, Any]]:
        """(value with aliases, legend): repeated strings and subtrees in value position, where that pays."""
        if not isinstance(value, (dict, list)):
            return value, {}
        forms: dict[int, str] = {}
        flat: set[int] = set()
        self._canonical_parts(value, forms, flat)
        found: list[tuple[str, str]] = []
        literal: set[str] = set()
        stack = [value]
        while stack:  # document order, so that ties rank by first sight
            x = stack.pop()
            if isinstance(x, (dict, list)):
                found.append(("j", forms[id(x)]))
                inner = x
                if isinstance(x, dict):
                    literal.update(x)
                    inner = x.values()
                if id(x) in flat:
                    found += [("s", text) for text in inner if type(text) is str]
                else:
                    stack += reversed([*inner])
            elif isinstance(x, str):
                found.append(("s", x))
        repeats = Counter(found)
        price = {key: self.cost(key[1]) if key[0] == "s" else self.count(key[1]) for key, n in repeats.items() if n > 1}
        ranked = sorted((key for key in price if price[key] > 0), key=lambda key: -(repeats[key] - 1) * price[key])
        names: dict[tuple[str, str], str] = {}
        number = 0
        for key in ranked:
            while (name := "~" + _base36(number)) in literal or ("s", name) in repeats:
                number += 1
            number += 1  # a number is spent even if the alias does not pay
            n, own = repeats[key], self.cost(name)
            if n * price[key] > n * own + own + price[key]:
                names[key] = name
        if not names:
            return value, {}
        used: dict[str, tuple[str, str]] = {}

        def swap(x: Any) -> Any:
            key = ("s", x) if isinstance(x, str) else ("j", forms[id(x)]) if isinstance(x, (dict, list)) else None
            if key in names:
                used[names[key]] = key
                return names[key]
            if isinstance(x, dict):
                return {k: swap(v) for k, v in x.items()}
            return [swap(v) for v in x] if isinstance(x, list) else x

        swapped = swap(value)
        legend = {name: key[1] if key[0] == "s" else json.loads(key[1]) for key, name in names.items() if name in used}
        return (swapped, legend) if legend else (value, {})

    def expand(self, value: Any, legend: dict[str, Any]) -> Any:
        if isinstance(value, str):
            return self.expand(legend[value], legend) if value in legend else value
        if isinstance(value, dict):
            return {k: self.expand(v, legend) for k, v in value.items()}
        return [self.expand(v, legend) for v in value] if isinstance(value, list) else value

    # --- whole payloads ---

    def tiers(self, value: Any, tables: bool = True, aliases: bool = True, embedded: bool = False) -> tuple[str, str, str]:
        """(compact text, text of the folded value, text of the cheapest tier) in one pass."""
        plain = minify(value)
        folded = self.fold(value, tables, embedded) if tables or embedded else value
        table = best = minify(folded)
        if aliases and not self._hopeless(folded, best):
            data, legend = self.alias(folded)
            coded = minify({self.dict: 1, "legend": legend, "data": data}) if legend else best
            best = coded if self.count(coded) < self.count(best) else best
        return plain, table, best if self.count(best) < self.count(plain) else plain

    def compress(self, value: Any, tables: bool = True, aliases: bool = True, embedded: bool = False) -> str:
        """The tiers' text, or the compact text where they are not strictly cheaper."""
        return self.tiers(value, tables, aliases, embedded)[2]

    def tabular(self, value: Any) -> str:
        """Tables only, even where they cost more: for measurement."""
        return minify(self.fold(value))

    def decompress(self, text: str) -> Any:
        value = json.loads(text)
        if isinstance(value, dict) and value.get(self.dict) == 1:
            value = self.expand(value["data"], value["legend"])
        return self.unfold(value)

    def gives(self, text: str, value: Any) -> bool:
        """Does the text give the value back?"""
        try:
            return equal(self.decompress(text), value)
        except (ValueError, KeyError, TypeError, RecursionError):
            return False

    def exact(self, value: Any, **tiers: bool) -> bool:
        """Does the payload come back?"""
        try:
            return self.gives(self.compress(value, **tiers), value)
        except (ValueError, KeyError, TypeError, RecursionError):
            return False

    def emit(self, raw: str, tables: bool = True, aliases: bool = True, embedded: bool = False) -> tuple[str, str]:
        """(text, what was done): checked before it is given; anything doubtful passes unchanged."""
        ok, value = parse(raw)
        if not ok:
            return raw, "passthrough"
        if self.reserved_in(raw, value):
            return raw, "reserved"
        text = self.compress(value, tables, aliases, embedded)
        try:
            if equal(self.decompress(text), value):
                return text, "compressed"
        except (ValueError, KeyError, TypeError, RecursionError):
            pass
        return minify(value), "fallback"

    def join_blocks(self, raws: list[str]) -> tuple[str | None, str]:
        """Blocks that are all objects as one array, or why not."""
        values = []
        for raw in raws:
            ok, value = parse(raw)
            if not ok:
                return None, "non_json"
            if not isinstance(value, dict):
                return None, "heterogeneous"
            if self.reserved_in(raw, value):
                return None, "marker"
            values.append(value)
        if len(values) < 2:
            return None, "single"
        if too_deep(values):
            return None, "depth"
        return minify(values), "joined"

    def measure(self, raw: str) -> dict[str, Any]:
        """Token counts and savings per tier; a failed gate voids what it guards."""
        ok, value = parse(raw)
        shape, base = _shape(raw, ok, value), self.count(raw)
        if not ok:
            counts = dict.fromkeys(("raw", "minified", "tabular", "compressed", "embedded"), base)
            gate = inner = True
        else:
            plain, table, best = self.tiers(value)
            # the embedded tier differs only where some string holds JSON, so begins with a bracket
            begins = any(sign in raw for sign in ('"{', '"[', '"\\u'))
            *_, deeper = (plain, table, best) if not begins or self.fold(value, False, True) == value else self.tiers(value, embedded=True)
            counts = {"raw": base} | {k: self.count(t) for k, t in zip(("minified", "tabular", "compressed", "embedded"), (plain, table, best, deeper))}
            gate = self.gives(best, value)
            inner = gate and (deeper == best or self.gives(deeper, value))
        steps = [("minify", "raw", "minified"), ("tabularize", "minified", "tabular"), ("dictionary", "tabular", "compressed"), ("embedded", "compressed", "embedded")]
        saved = {name: counts[a] - counts[b] if gate and (inner or name != "embedded") else 0 for name, a, b in steps}
        total = base - counts["embedded" if inner else "compressed"] if gate else 0
        return {"shape": shape, "applicable": ok, "roundtrip_ok": gate, "embedded_ok": inner, **{f"{k}_tok": v for k, v in counts.items()}, **{f"saved_{k}": v for k, v in saved.items()}, "saved_total": total}


def same_mirror(block: str, structured: str) -> bool:
    """Is a text block the structured content once more?"""
    (ok, a), (also, b) = parse(block), parse(structured)
    return ok and also and canonical(a) == canonical(b)

"""JSON values: parsing, exact serializations, equality, depth."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from typing import Any

# Serializations that an embedded document may have, by their id on the wire.
FORMS: dict[str, dict[str, Any]] = {
    "p": {},
    "P": {"ensure_ascii": False},
    "c": {"separators": (",", ":")},
    "C": {"separators": (",", ":"), "ensure_ascii": False},
    "i2": {"indent": 2},
    "I2": {"indent": 2, "ensure_ascii": False},
    "i4": {"indent": 4},
    "I4": {"indent": 4, "ensure_ascii": False},
}
DEEPEST = 200


def _writer(form: dict[str, Any]) -> Callable[[Any], str]:
    """json.dumps of a form, its encoder made once (a value parsed from text has no circles to look for)."""
    plain = json.JSONEncoder(check_circular=False, **form)
    make = json.encoder.c_make_encoder
    if make is None or plain.indent is not None:
        return plain.encode
    quote = json.encoder.encode_basestring_ascii if plain.ensure_ascii else json.encoder.encode_basestring
    parts = make(None, plain.default, quote, None, plain.key_separator, plain.item_separator, False, False, True)
    return lambda value: quote(value) if type(value) is str else "".join(parts(value, 0))


WRITE = {name: _writer(form) for name, form in FORMS.items()}
_compact = WRITE["C"]
#: What json makes of a value that holds no other.
SCALARS = frozenset((str, int, float, bool, type(None)))


def minify(value: Any) -> str:
    return _compact(value)


def canonical(value: Any) -> str:
    """Compact JSON with sorted keys; a string is itself."""
    return value if isinstance(value, str) else json.dumps(value, sort_keys=True, **FORMS["C"])


def chars4(text: str) -> int:
    """The default token counter."""
    return max(1, len(text) // 4)


def parse(text: str | None) -> tuple[bool, Any]:
    """(is JSON of bearable depth, value)."""
    if text is None:
        return False, None
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return False, None
    # no more levels than brackets
    return text.count("{") + text.count("[") <= DEEPEST or not too_deep(value), value


def children(value: Any) -> list:
    return list(value.values()) if isinstance(value, dict) else value if isinstance(value, list) else []


def too_deep(value: Any, most: int = DEEPEST) -> bool:
    """Containers nested more than ``most`` levels (level by level, no recursion)."""
    level, depth = [value], 0
    while level := [x for x in level if isinstance(x, (dict, list))]:
        depth += 1
        if depth > most:
            return True
        level = [child for x in level for child in (x.values() if isinstance(x, dict) else x)]
    return False


def equal(a: Any, b: Any) -> bool:
    """Equality in which NaN equals NaN at the same place; 1, 1.0 and true stay equal."""
    try:
        if a == b:  # the interpreter's own comparison is stricter, as to NaN only
            return True
    except RecursionError:
        pass
    work = [(a, b)]
    while work:
        x, y = work.pop()
        if isinstance(x, dict) and isinstance(y, dict):
            if x.keys() != y.keys():
                return False
            work += [(x[k], y[k]) for k in x]
        elif isinstance(x, list) and isinstance(y, list):
            if len(x) != len(y):
                return False
            work += zip(x, y)
        elif isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y):
            continue
        elif x != y:
            return False
    return True

"""Replies to questions with a known answer: what a reply says, read once, against what is expected."""

from __future__ import annotations

import json
import re
from functools import cached_property
from typing import Any

# A number that stands alone, what counts as the same number, the signs that part a list, and quotes.
ALONE = r"(?<![A-Za-z0-9_.])-?\d+(?:\.\d+)?(?![A-Za-z0-9_])"
SAME = 1e-9
PARTING = ",\n"
QUOTES = "\"'"


class Reply:
    """One reply, with the readings that answers of each kind are compared with."""

    def __init__(self, text: str):
        self.text = text.strip()

    @cached_property
    def numbers(self) -> list[float]:
        return list(map(float, re.findall(ALONE, self.text)))

    def embedded(self, brackets: str) -> Any:
        """JSON from the first opening to the last closing bracket; ValueError if there is none."""
        _, opening, rest = self.text.partition(brackets[0])
        inner, closing, _ = rest.rpartition(brackets[1])
        return json.loads(opening + inner + closing)

    @cached_property
    def structure(self) -> list[Any]:
        """The object, list or whole text that the reply is as JSON, the first of them that parses, or nothing."""
        for read in (lambda: self.embedded("{}"), lambda: self.embedded("[]"), lambda: json.loads(self.text)):
            try:
                return [read()]
            except ValueError:
                pass
        return []

    @cached_property
    def items(self) -> list[str] | None:
        """The members of a list, normal: a JSON array, or what commas and lines part, if anything."""
        try:
            found = self.embedded("[]")
        except ValueError:
            found = None
        if not isinstance(found, list):
            found = [*filter(str.strip, self.text.translate({ord(x): "\n" for x in PARTING}).split("\n"))] or None
        return None if found is None else [normal(x) for x in found]

    # --- answers by type of question -------------------------------------------

    def only(self, number: Any) -> bool:
        return len(self.numbers) == 1 and self.names(number)

    def names(self, number: Any) -> bool:
        return any(abs(x - float(number)) < SAME for x in self.numbers)

    def lists(self, members: list) -> bool:
        return self.items == [normal(x) for x in members]

    def holds(self, value: Any) -> bool:
        return value in self.structure

    def says(self, value: Any) -> bool:
        return self.names(value) if is_number(value) else normal(self.text) == normal(value)


#: Types of question that settle how they are compared; all others go by what is expected.
COMPARED = {"sole_number": Reply.only, "count": Reply.names, "enumerate": Reply.lists, "deref": Reply.holds}


def is_number(x: Any) -> bool:
    return type(x) in (int, float)


def normal(x: Any) -> str:
    """A scalar as it compares: without outer space, quotes and case."""
    return str(x).strip().strip(QUOTES).strip().lower()


def score(qtype: str, expected: Any, reply: str) -> bool:
    """Lenient about form, strict about the value."""
    return COMPARED.get(qtype, Reply.says)(Reply(reply), expected)


def score_form(qtype: str, expected: Any, replies: Any) -> tuple[int, int]:
    """(right, trials) of one reply or of a list of them; what is no text is a trial that fails."""
    trials = replies if isinstance(replies, list) else [replies]
    right = [score(qtype, expected, r) for r in trials if isinstance(r, str)]
    return right.count(True), len(trials)

"""Which explanations a model needs for the forms that a policy can send."""

from __future__ import annotations

# Sections in the order they are sent, and the tiers that make them reachable.
SECTIONS = {
    "head": "Results may use a compact form that stands for the full data.",
    "table": "A table names its columns once in cols; each row gives the values in that order.",
    "dict": "A legend maps aliases to values; put the value wherever its alias stands.",
    "embedded": "An embedded document stands for the string that its form would write.",
    "diff": "A delta is read against the previous result of the same tool.",
    "dropped": "A handle stands for a value that can be fetched when it is needed.",
    "tail": "Answer from the full data that the form stands for.",
}
NEEDS = {"table": {"tabularize"}, "dict": {"dictionary"}, "embedded": {"embedded"}}


def reachable(policy: dict) -> set[str]:
    """Sections that some rule or default of the policy can make necessary."""
    tiers = {t for rule in [*policy.get("rules", []), {"tiers": policy.get("defaults", {}).get("tiers", [])}] for t in rule.get("tiers", [])}
    lossy = any(isinstance(s, dict) and s.get("lossy") == "drop-to-retrieve" for r in policy.get("rules", []) for s in r.get("fields", {}).values())
    return {name for name, need in NEEDS.items() if need & tiers} | ({"diff"} if policy.get("diff") else set()) | ({"dropped"} if lossy else set())


def primer(*policies: dict) -> str:
    """One text for all peers: a section is in if any of them can need it; none needed, none sent."""
    needed = set().union(*map(reachable, policies)) if policies else set()
    return "\n".join(text for name, text in SECTIONS.items() if name in needed or name in ("head", "tail")) if needed else ""

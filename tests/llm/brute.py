"""Plain versions of the operators, and documents with every awkward case."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def awkward(seed=1):
    """Rows of documents: nulls, blanks, ties, repeated rows, long texts, shared passages, odd characters."""
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma,", "d", "é́x", "zwölf", "of", "the", "x1", "…", "日本", "a b"]
    text = lambda n: " ".join(rng.choice(words) + (str(rng.randrange(30)) if rng.random() < 0.5 else "") for _ in range(n))
    passage, other = text(90), text(200)
    rows = [(1, None), (2, ""), (3, "  \t\n "), (4, "one"), (5, "one"), (6, "two words"), (None, passage), (None, text(30))]
    rows += [(10, passage), (11, text(40) + "\n" + passage + "\n" + text(3)), (12, passage + " " + passage), (13, other), (13, other), (14, other[:-5] + " end"), (15, other.upper())]
    rows += [(16, text(12) + " " + " ".join(passage.split()[20:60]) + " tail"), (16, "same id, other text " + text(25)), (17, ("ab " * 400)), (18, "x" * 3000), (19, "x" * 2999)]
    rows += [(20 + i, text(rng.choice([1, 5, 19, 20, 21, 60]))) for i in range(12)] + [(50, text(9000)), (51, "tab\tsep\x0bvert\x1cfs " * 9)]
    return [(i, t, "en" if (i or 0) % 2 else None, f"src{(i or 0) % 3}", None if t is None else len(t)) for i, t in rows]


def windows_before(rows, length=20):
    """(n_words, n_removed, kept hash) in row order; null ids are one document before all others."""
    key = lambda i: -(1 << 63) if i is None else i
    first = {}
    docs = [(key(i), SPACE_WORD.findall(t or "")) for i, t, *_ in rows]
    for i, w in docs:
        for s in range(len(w) - length + 1):
            k = tuple(w[s : s + length])
            first[k] = min(first.get(k, (i, s)), (i, s))
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            if first[tuple(w[s : s + length])] < (i, s):
                gone[s : s + length] = [True] * length
        out.append((len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def bytes_anywhere(rows, length=400):
    data = [(t or "").encode() for _, t, *_ in rows]
    count = Counter(b[s : s + length] for b in data for s in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if count[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        runs = sum(gone[i] and (not i or not gone[i - 1]) for i in range(len(b)))
        out.append((len(b), sum(gone), int(runs), sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def contamination(rows, items, most=10):
    found = {}
    for i, t in items:
        w = ALNUM_WORD.findall(lower(t))
        n = min(most, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            found.setdefault(tuple(w[s : s + n]), set()).add("null" if i is None else str(i))
    out = []
    for _, t, *_ in rows:
        w, hit, got = ALNUM_WORD.findall(lower(t)), set(), set()
        for n in {len(k) for k in found}:
            for s in range(len(w) - n + 1):
                if ids := found.get(tuple(w[s : s + n])):
                    hit |= set(range(s, s + n))
                    got |= ids
        out.append((len(w), len(hit), len(got), sha(",".join(sorted(got))), bool(hit)))
    return out


def fingerprint(text, width=3):
    w = SPACE_WORD.findall(lower(text))
    shingles = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash(rows, budget=2):
    prints = np.array([fingerprint(t) for _, t, *_ in rows], np.uint64)
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if int(prints[a] ^ prints[b]).bit_count() <= budget:
                up[find(a)] = find(b)
    groups = {}
    for k, (i, *_) in enumerate(rows):
        groups.setdefault(find(k), []).append(i)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return [(f"{int(p):016x}", least[find(k)]) for k, p in enumerate(prints)]


def pieces(rows, tokenizer, length=2048):
    out = []
    for i, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), length):
            part = ids[k : k + length]
            out.append((i, k // length, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def local_alignment(template, words, match=2, miss=-1):
    """Matched words of the best local alignment, the whole table filled."""
    best, matched = 0, 0
    before = [(0, 0)] * (len(words) + 1)
    for t in template:
        row = [(0, 0)]
        for j, w in enumerate(words, 1):
            s, m = before[j - 1]
            step = (s + match, m + 1) if t == w else (s + miss, m)
            step = max(step, (before[j][0] + miss, before[j][1]), (row[j - 1][0] + miss, row[j - 1][1]), key=lambda x: x[0])
            row.append(step if step[0] > 0 else (0, 0))
            if row[j][0] > best:
                best, matched = row[j]
        before = row
    return matched


def shared_run(a, b):
    """Most consecutive words that both hold."""
    best, before = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(before[j - 1] + 1 if x == y else 0)
        best, before = max(best, *row), row
    return best


def in_order(a, b):
    """Most words of both in the same order."""
    before = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(before[j - 1] + 1 if x == y else max(before[j], row[j - 1]))
        before = row
    return before[-1]

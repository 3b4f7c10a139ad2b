"""The pipeline's near-copy stage against all pairs of shingle sets, and planted copies."""

import random

import brute
import numpy as np
import pytest

from sparloom.llm import near_copies, simhash
from sparloom.llm.trie import trie_pairs


def shingles(text, width=5):
    w = brute.SPACE_WORD.findall(brute.lower(text))
    return frozenset(" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def standing(rows, alike=0.8):
    """Ids that stand for their component, by all pairs."""
    sets, up = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def find(x):
        return x if up[x] == x else find(up[x])

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] == sets[b] or len(sets[a] & sets[b]) >= alike * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    groups = {}
    for k, r in enumerate(rows):
        groups.setdefault(find(k), []).append(r[0])
    return {min(g) for g in groups.values()}


def planted(seed=5, bases=60, hot=0):
    """Texts, each with a copy of a few changed words (or ``hot`` of the first), and unlike ones."""
    rng = random.Random(seed)
    rows, words = [], [f"w{k}" for k in range(3000)]
    for base in range(bases):
        text = [rng.choice(words) for _ in range(rng.randrange(60, 300))]
        rows.append((len(rows), " ".join(text), None, None, 0))
        for _ in range(hot if hot and not base else 1):
            copy = list(text)
            for _ in range(max(1, len(text) // 60)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy), None, None, 0))
    return rows


def test_planted_near_copies_go(spark, sf):
    rows = planted()
    want = standing(rows)
    got = {r.doc_id for r in simhash.stage(spark, spark.createDataFrame(rows, brute.SCHEMA), sf).collect()}
    assert len(want) < 0.6 * len(rows) and got == want


@pytest.mark.parametrize("block", [near_copies.BLOCK, 24])
def test_large_bucket(spark, sf, monkeypatch, block):
    """Many near copies in one bucket, whole or dealt in blocks and tiles: the same as by all pairs."""
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rows = planted(6, 5, 160)
    got = {r.doc_id for r in simhash.stage(spark, spark.createDataFrame(rows, brute.SCHEMA), sf).collect()}
    assert got == standing(rows)


def test_copies_around_no_centre(spark, sf):
    """Chains: each text is like the next one only, so stars find few of the links."""
    rng = random.Random(2)
    words = [f"w{k}" for k in range(2000)]
    text, rows = [rng.choice(words) for _ in range(200)], []
    for k in range(60):
        rows.append((k, " ".join(text), None, None, 0))
        text = text[3:] + [rng.choice(words) for _ in range(3)]
    got = {r.doc_id for r in simhash.stage(spark, spark.createDataFrame(rows, brute.SCHEMA), sf).collect()}
    assert got == standing(rows) == {0}


@pytest.mark.parametrize("n", [2, 5, 60, 300])
def test_trie_pairs(n):
    rng = np.random.default_rng(n)
    prints = rng.integers(0, 1 << 63, (4, 4), dtype=np.uint64)[rng.integers(0, 4, n)]
    for r in range(n):
        for _ in range(rng.integers(0, 60)):
            prints[r, rng.integers(4)] ^= np.uint64(1) << np.uint64(rng.integers(64))
    root = rng.integers(0, max(1, n // 3), n)
    got = [tuple(sorted(p)) for x, y in trie_pairs(prints, 64, root) for p in zip(x.tolist(), y.tolist())]
    want = {(a, b) for a in range(n) for b in range(a + 1, n) if root[a] != root[b] and np.bitwise_count(prints[a] ^ prints[b]).sum() <= 64}
    assert len(got) == len(set(got)) and set(got) == want


def test_unlike_texts_stay(spark, sf):
    rows = [(1, "a b c d", None, None, 0), (2, "A  b c\td", None, None, 0), (3, "a b c e", None, None, 0), (4, "", None, None, 0), (5, None, None, None, 0)]
    assert sorted(r.doc_id for r in simhash.stage(spark, spark.createDataFrame(rows, brute.SCHEMA), sf).collect()) == [1, 3, 4]

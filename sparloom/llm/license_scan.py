"""License scan: winnowed fingerprints, an inverted index, banded alignment.

Templates and documents keep, of every 3 consecutive 3-word grams, the rightmost
least hash; any 5 words that both share leave a common fingerprint (templates of
under 10 words keep all their grams).  The inverted index of the templates (a parameter of the call, so of known size) goes to every
task; a document's fingerprints pick (template, diagonal) candidates, and a
banded local alignment of words (match 2, mismatch or gap -1) around the
diagonal reports which template words matched and where.

Aligned passages of one template that follow each other in document and template
order are chained, so a template broken by insertions of any length is one row;
template words that two of them match (any number where the passages overlap in the
document, as those of neighbouring diagonals do, else up to ``BAND``) count once.  One row per chain:
document, template, word span [first_word, last_word), matched and template words,
coverage = matched / template words, and the spans of its passages.  Chains that
cover at least ``LEAST`` of a template are reported.  No shuffle is needed.

Defined cases: null texts have no words and no rows; repeated rows report again;
a passage that matches several templates is reported for each, but a chain of
several passages that all lie within a longer match of another template is not
reported; a template may
occur any number of times in a document; further columns are not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .decontaminate import LOWER, WORD
from .license_templates import TEMPLATES

GRAM, WINDOW, BAND, LEAST = 3, 3, 8, 0.5
MATCH, MISS = 2, -1
_SPANS = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64())]))


def _words(data, off):
    low = LOWER[data]
    starts, ends, first = c.words_of(low, off, WORD)
    return low.tobytes(), starts, ends, first, c.Prefix(c.LUT_A[low]).hash(starts, ends)


def _fingerprints(wh, first, whole_under: int = GRAM + WINDOW - 1):
    """(positions, hashes) that winnowing keeps; rows of fewer words than ``whole_under`` keep all their grams."""
    h = c.kgrams(wh, GRAM)
    row = c.rows_of(first)
    n = len(h)
    whole = row[:n] == row[GRAM - 1 : GRAM - 1 + n]
    pick = c.window_argmin(h, WINDOW)
    reach = GRAM + WINDOW - 1
    ok = row[: len(pick)] == row[reach - 1 : reach - 1 + len(pick)]
    at = pick[ok]
    short = np.flatnonzero(whole & (np.diff(first)[row[:n]] < whole_under)) if n else at
    at = np.unique(np.concatenate([at, short]))
    return at, h[at]


class Index:
    """Inverted index: sorted fingerprint hashes -> (template, position)."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        texts = pa.array([templates[n] for n in self.names])
        data, off = c.text_buffers(texts)
        text, starts, ends, first, wh = _words(data, off)
        self.words = [c.strings(text, starts[a:b], ends[a:b]) for a, b in zip(first[:-1], first[1:])]
        at, h = _fingerprints(wh, first, 2 * (GRAM + WINDOW - 1))
        row = c.rows_of(first)
        order = np.argsort(h, kind="stable")
        at = at[order]
        self.hashes, self.template, self.place = h[order], row[at], at - first[row[at]]

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of h, which entry) pairs."""
        lo, hi = np.searchsorted(self.hashes, h, "left"), np.searchsorted(self.hashes, h, "right")
        which = np.flatnonzero(hi > lo)
        many = (hi - lo)[which]
        return np.repeat(which, many), np.repeat(lo[which] - np.append(0, np.cumsum(many))[:-1], many) + np.arange(int(many.sum()))


def align(template: list[bytes], words: list[bytes], shift: int, band: int = BAND) -> tuple[int, int, int]:
    """(matched words, first word, end word) of the best passage."""
    matched, first, last = matches(template, words, shift, band)
    return len(matched), first, last


def matches(template: list[bytes], words: list[bytes], shift: int, band: int = BAND) -> tuple[list[tuple[int, int]], int, int]:
    """Banded local alignment: ((template word, word) pairs, first word, end word) of the best passage.

    Cell (i, j) compares template word i with word j; only |j - i - shift| <= band is filled.
    """
    width = 2 * band + 1
    best, end = 0, None
    score = [[0] * (width + 2) for _ in range(len(template) + 1)]
    back = [bytearray(width + 2) for _ in range(len(template) + 1)]
    for i in range(1, len(template) + 1):
        before, row, steps, word = score[i - 1], score[i], back[i], template[i - 1]
        for d in range(1, width + 1):
            j = i + shift + d - 1 - band  # words[j - 1] meets template[i - 1]
            if j < 1 or j > len(words):
                continue
            s, step = before[d] + (MATCH if words[j - 1] == word else MISS), 1
            if before[d + 1] + MISS > s:
                s, step = before[d + 1] + MISS, 2  # the template word is missing
            if row[d - 1] + MISS > s:
                s, step = row[d - 1] + MISS, 3  # a word too many
            if s > 0:
                row[d], steps[d] = s, step
                if s > best:
                    best, end = s, (i, d)
    if end is None:
        return [], 0, 0
    (i, d), matched = end, []
    last = first = i + shift + d - 1 - band
    while score[i][d] > 0:
        j, step = i + shift + d - 1 - band, back[i][d]
        if step == 1:
            if words[j - 1] == template[i - 1]:
                matched.append((i - 1, j - 1))
            first = j - 1
            i -= 1
        elif step == 2:
            i, d = i - 1, d + 1
        else:
            d -= 1
    return matched[::-1], first, last


def best_chain(parts: list[tuple[list[tuple[int, int]], int, int]]) -> tuple[int, list[int]]:
    """(matched words, which parts) of the chain with most matched words; parts are (pairs, first word, end word) by first word."""
    total, back = [], []
    for k, (pairs, first, last) in enumerate(parts):
        score, at = len(pairs), -1
        for p in range(k):
            before, a, b = parts[p]
            if a >= first or b >= last or before[0][0] >= pairs[0][0] or before[-1][0] >= pairs[-1][0]:
                continue
            gain = sum(i > before[-1][0] and j >= b for i, j in pairs)
            if gain and (first < b or len(pairs) - gain <= BAND) and total[p] + gain > score:
                score, at = total[p] + gain, p
        total.append(score)
        back.append(at)
    k = max(range(len(parts)), key=lambda x: total[x])
    chain, score = [], total[k]
    while k >= 0:
        chain.append(k)
        k = back[k]
    return score, chain[::-1]


def _scan(index, least: float):
    def passages(entries, words, ix):
        """entries: (template, place, word) hits of one document."""
        found, parts = [], {}
        entries = sorted(entries, key=lambda e: (e[0], e[2] - e[1], e[2]))
        at = 0
        while at < len(entries):
            t, first = entries[at][0], entries[at][2] - entries[at][1]
            upto, shift = at, first
            while upto < len(entries) and entries[upto][0] == t and entries[upto][2] - entries[upto][1] - shift <= BAND // 2 and entries[upto][2] - entries[upto][1] - first <= BAND:
                shift = entries[upto][2] - entries[upto][1]
                upto += 1
            template = ix.words[t]
            middle = (first + shift) // 2
            lo = max(0, middle - BAND)
            part = words[lo : max(0, middle) + len(template) + BAND]
            pairs, a, b = matches(template, part, middle - lo)
            if pairs:
                parts.setdefault(t, []).append(([(i, lo + j) for i, j in pairs], lo + a, lo + b))
            at = upto
        for t, left in parts.items():
            left.sort(key=lambda p: (p[1], p[2]))
            size = len(ix.words[t])
            while left:
                matched, chain = best_chain(left)
                if matched < least * size:
                    break
                spans = [left[k][1:] for k in chain]
                found.append((ix.names[t], spans[0][0], spans[-1][1], matched, size, [{"first_word": a, "last_word": b} for a, b in spans]))
                # one passage is reported once, by its best chain
                left = [p for p in left if not any(p[1] < b and a < p[2] for a, b in spans)]
        # pieces within a better match of another template are that licence's words, not a broken one of this
        inside = lambda f, g: all(any(y["first_word"] <= x["first_word"] and x["last_word"] <= y["last_word"] for y in g[5]) for x in f[5])
        found = [f for f in found if len(f[5]) == 1 or not any(g[0] != f[0] and g[3] > f[3] and inside(f, g) for g in found)]
        return sorted(found, key=lambda f: (f[1], f[0]))

    def run(batches):
        ix = index.value
        for batch in batches:
            data, off = c.text_buffers(batch.column(1))
            rows, out = [], []
            for i, _, part, poff in c.chunks(data, off):
                text, starts, ends, first, wh = _words(part, poff)
                at, h = _fingerprints(wh, first)
                which, entry = ix.hits(h)
                row = c.rows_of(first)[at[which]]
                hits = zip(row.tolist(), ix.template[entry].tolist(), ix.place[entry].tolist(), (at[which] - first[row]).tolist())
                by_row = {}
                for r, t, place, word in hits:
                    by_row.setdefault(r, []).append((t, place, word))
                for r, entries in by_row.items():
                    words = c.strings(text, starts[first[r] : first[r + 1]], ends[first[r] : first[r + 1]])
                    for f in passages(entries, words, ix):
                        rows.append(i + r)
                        out.append(f)
            name, a, b, matched, size, spans = zip(*out) if out else ((),) * 6
            matched, size = np.array(matched, np.int64), np.array(size, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(name, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(matched), pa.array(size), pa.array(matched / np.maximum(size, 1)), pa.array(spans, _SPANS)],
                names=["id", "license", "first_word", "last_word", "matched_words", "template_words", "coverage", "spans"],
            )

    return run


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """(id, license, first_word, last_word, matched_words, template_words, coverage, spans) of every chain of passages."""
    index = docs.sparkSession.sparkContext.broadcast(Index(TEMPLATES if templates is None else templates))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(_scan(index, least), f"id {kind}, license string, first_word long, last_word long, matched_words long, template_words long, coverage double, spans array<struct<first_word:long,last_word:long>>")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(c.read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")

"""Benchmark decontamination by winnowing.

A window is 10 consecutive words of a benchmark item (an item of fewer words,
but not none, is one window).  A document word inside any occurrence of a window
is hit.

1. Both sides keep, of every 6 consecutive 5-word grams, the rightmost least
   hash.  Six 5-grams make 10 words, and the choice depends on those words only,
   so every shared window shares a kept gram at the same place: none is missed.
   Items under 10 words are kept whole, and documents are looked up at those
   lengths.
2. Fingerprints carry their surroundings: the words up to 5 before and 5 after.
   They are joined by hash, and the hit is extended word by word over the
   surroundings; 10 or more agreeing words are hit words.  Words are compared
   as text, so a hash collision can't make a hit.

Scale: documents are scanned once.  A Bloom filter of the benchmark's
fingerprints, of fixed size (1 MB), drops nearly all document fingerprints
before the shuffle; it is built by a distributed bit-or, and a larger benchmark
only lets more pass.  Both sides of the join collapse equal surroundings first
(per document, and per benchmark), so a passage that very many documents hold is
one row for each of them; such a hash is split over salted keys.

Defined cases: null texts have no words (n_words 0, not contaminated); items
without words have no windows; repeated rows each get their own row; items with
one id are one item; null item ids take part and count as the string 'null'.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

WINDOW, GRAM = 10, 5
SPAN = WINDOW - GRAM
BLOOM_BITS = 1 << 23
SALTS = 32

WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

FOUND = "key long, word0 int, left array<binary>, core binary, right array<binary>"


class _Rows:
    """Lower-cased words of a run of rows and the hashes of their winnowed grams."""

    def __init__(self, data, off):
        self.data = LOWER[data]
        self.starts, self.ends, self.first = c.words_of(self.data, off, WORD)
        self.row = c.rows_of(self.first)
        self.wh = c.Prefix(c.LUT_A[self.data]).hash(self.starts, self.ends)
        self.text = self.data.tobytes()

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, hash) of the n-grams within a row; the hash is salted by n."""
        h = c.kgrams(self.wh, n)
        at = np.flatnonzero(self.row[: len(h)] == self.row[n - 1 : n - 1 + len(h)])
        return at, c.mix(h[at] + c.U(n))

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(position, hash) of the grams that winnowing keeps."""
        h = c.kgrams(self.wh, GRAM)
        pick = c.window_argmin(h, WINDOW - GRAM + 1)
        ok = self.row[: len(pick)] == self.row[WINDOW - 1 : WINDOW - 1 + len(pick)]
        at = np.unique(pick[ok])
        return at, c.mix(h[at] + c.U(GRAM) + c.U(1 << 32))

    def piece(self, a: int, b: int) -> bytes:
        """Words a to b, a space after each."""
        return b"".join(self.text[x:y] + b" " for x, y in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist()))

    def words(self, a: int, b: int) -> list[bytes]:
        return [self.text[x:y] for x, y in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist())]

    def around(self, at: int, n: int) -> tuple[list[bytes], bytes, list[bytes]]:
        """Words before (nearest first), the gram, words after, within the row."""
        if n < 0:  # a whole short item: nothing to extend
            return [], self.piece(at, at - n), []
        lo, hi = self.first[self.row[at]], self.first[self.row[at] + 1]
        left = self.words(max(lo, at - SPAN), at)[::-1]
        return left, self.piece(at, at + n), self.words(at + n, min(hi, at + n + SPAN))


def _item_rows(batches):
    """Fingerprints of benchmark items (id string, text)."""
    for batch in batches:
        data, off = c.text_buffers(batch.column(1))
        ids = batch.column(0).to_pylist()
        out = {k: [] for k in ("id", "n", "key", "left", "core", "right")}
        for i, j, part, poff in c.chunks(data, off):
            rows = _Rows(part, poff)
            size = np.diff(rows.first)
            picks = [(at, h, GRAM) for at, h in zip(*map(np.ndarray.tolist, rows.anchors()))]
            for n in set(size[(size > 0) & (size < WINDOW)].tolist()):
                picks += [(at, h, -n) for at, h in zip(*map(np.ndarray.tolist, rows.grams(n))) if size[rows.row[at]] == n]
            for at, h, n in picks:
                left, core, right = rows.around(at, n)
                for name, x in zip(out, (ids[i + int(rows.row[at])], n, np.uint64(h).astype(np.int64), left, core, right)):
                    out[name].append(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["id"], pa.string()), pa.array(out["n"], pa.int32()), pa.array(np.array(out["key"], np.int64)), pa.array(out["left"], pa.list_(pa.binary())), pa.array(out["core"], pa.binary()), pa.array(out["right"], pa.list_(pa.binary()))],
            names=list(out),
        )


def _bloom_words(keys: np.ndarray) -> np.ndarray:
    h = keys.view(np.uint64)
    return np.stack([h % c.U(BLOOM_BITS), (h >> c.U(23)) % c.U(BLOOM_BITS), (h >> c.U(41)) % c.U(BLOOM_BITS)])


def bloom(prints: DataFrame) -> np.ndarray:
    """Bits of the fingerprints' filter: at most BLOOM_BITS / 64 rows reach the driver."""

    def bits(batches):
        for batch in batches:
            at = np.unique(_bloom_words(batch.column(0).to_numpy()).ravel())
            yield pa.RecordBatch.from_arrays([pa.array((at >> c.U(6)).astype(np.int32)), pa.array(c.signed(c.U(1) << (at & c.U(63))))], names=["word", "bits"])

    found = prints.select("key").mapInArrow(bits, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    made = np.zeros(BLOOM_BITS // 64, np.int64)
    made[found["word"].to_numpy()] = found["bits"].to_numpy()
    return made.view(np.uint64)


def _doc_rows(filter_words, short_lengths):
    """(row, n_words, [fingerprints in the filter]) of (row key, text) batches."""

    def maybe(h):
        a, b, d = _bloom_words(h)
        bits = filter_words.value
        test = lambda x: (bits[(x >> c.U(6)).astype(np.int64)] >> (x & c.U(63))) & c.U(1)
        return np.flatnonzero(test(a) & test(b) & test(d))

    def run(batches):
        for batch in batches:
            data, off = c.text_buffers(batch.column(1))
            n_words, found, lengths = [], [], []
            for i, j, part, poff in c.chunks(data, off):
                rows = _Rows(part, poff)
                n_words += np.diff(rows.first).tolist()
                per_row = {}
                for n, (at, h) in [(GRAM, rows.anchors()), *((-n, rows.grams(n)) for n in short_lengths)]:
                    hit = maybe(h)
                    for a, x in zip(at[hit].tolist(), c.signed(h[hit]).tolist()):
                        r = int(rows.row[a])
                        left, core, right = rows.around(a, n)
                        per_row.setdefault(r, {}).setdefault((x, core, tuple(left), tuple(right)), []).append(a - int(rows.first[r]))
                for r in range(j - i):
                    got = per_row.get(r, {})
                    lengths.append(len(got))
                    found += [{"key": k, "core": core, "left": list(le), "right": list(ri), "at": at} for (k, core, le, ri), at in got.items()]
            kind = pa.struct([("key", pa.int64()), ("core", pa.binary()), ("left", pa.list_(pa.binary())), ("right", pa.list_(pa.binary())), ("at", pa.list_(pa.int32()))])
            offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:1], pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(found, kind))],
                names=["id", "n_words", "prints"],
            )

    return run


def _common(left: str, right: str):
    """How many leading elements two arrays of at most SPAN share: the lengths at which they agree."""
    return F.expr(f"size(filter(sequence(1, {SPAN}), k -> k <= size({left}) and k <= size({right}) and slice({left}, 1, k) = slice({right}, 1, k)))")


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(row, id, n_words, spans [(from, to) words], items [string]) for each row of ``docs``.

    ``row`` numbers the rows within this call only.
    """
    spark = docs.sparkSession
    ws = c.Workspace(spark, "decontaminate")
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("id"), F.col(item_text_col).cast("string").alias("body"))
    prints = ws.save(items.mapInArrow(_item_rows, "id string, n int, key long, left array<binary>, core binary, right array<binary>"), "items")
    short = sorted(-r.n for r in prints.where("n < 0").select("n").distinct().collect())  # at most 9
    words = spark.sparkContext.broadcast(bloom(prints))
    rows = docs.select(F.struct(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc")).alias("id"), F.col(text_col).cast("string").alias("body"))
    kind = rows.schema["id"].dataType.simpleString()
    scanned = ws.save(rows.mapInArrow(_doc_rows(words, short), f"id {kind}, n_words long, prints array<struct<key:long,core:binary,left:array<binary>,right:array<binary>,at:array<int>>>"), "documents")
    salt = F.pmod(F.col("row"), F.lit(SALTS))
    seeds = scanned.select(F.col("id.row").alias("row"), F.explode("prints").alias("d")).select("row", "d.*", salt.alias("salt"))
    ours = prints.select("key", "n", F.col("core").alias("core_"), F.col("left").alias("left_"), F.col("right").alias("right_"), "id").distinct()
    ours = ours.withColumn("salt", F.explode(F.array(*(F.lit(k).cast("long") for k in range(SALTS)))))
    met = seeds.join(ours.hint("merge"), ["key", "salt"]).where("core = core_")
    before, after = _common("left", "left_"), _common("right", "right_")
    met = met.select("row", "at", "id", "n", before.alias("before"), after.alias("after"))
    met = met.withColumn("length", F.when(F.col("n") < 0, -F.col("n")).otherwise(F.col("n") + F.col("before") + F.col("after")))
    met = met.where((F.col("n") < 0) | (F.col("length") >= WINDOW))
    hit = met.select("row", "id", F.explode("at").alias("at"), "before", "length").select("row", "id", (F.col("at") - F.col("before")).alias("from"), (F.col("at") - F.col("before") + F.col("length")).alias("to"))
    hit = hit.groupBy("row").agg(F.collect_set(F.struct("from", "to")).alias("spans"), F.array_sort(F.collect_set("id")).alias("items"))
    return scanned.select("id.row", F.col("id.doc").alias("id"), "n_words").join(hit, "row", "left")


def _count(batches):
    """(doc_id, n_words, n_hit, ...) of find_contamination's rows."""
    for batch in batches:
        n_hit = []
        for spans in batch.column(2).to_pylist():
            lo, hi = (np.array([s[x] for s in spans or ()], np.int64) for x in ("from", "to"))
            lo, hi = c.merge_ranges(lo, hi)
            n_hit.append(int((hi - lo).sum()))
        items = [x or [] for x in batch.column(3).to_pylist()]
        digest = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(digest), pa.array([n > 0 for n in n_hit])],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tests = (c.read_table(spark, sf_dir, x) for x in ("documents", "benchmark"))
    found = find_contamination(docs, tests).select("id", "n_words", "spans", "items")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(_count, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go, whole; clean ones stay as they are."""
    key, tid, own = (c.fresh(docs.columns, x) for x in ("_key", "_tid", "_own"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = docs.withColumns({key: c.id_key(F.col("doc_id")), tid: F.xxhash64(text)})
    found = find_contamination(named.withColumn(own, F.struct(key, tid)), c.read_table(spark, sf_dir, "benchmark"), own)
    gone = found.where(F.col("spans").isNotNull()).select(f"id.{key}", f"id.{tid}").distinct()
    return named.join(gone, [key, tid], "left_anti").select(*docs.columns)

"""Substring dedup by seed and extend.

A word window (20 words here) goes when the same word sequence starts earlier:
in a document with a smaller id, or earlier in the same document.

1. Seeds.  Every window picks its anchor by winnowing: the rightmost least hash
   among its 8-word grams.  Equal windows pick the same anchor, and the windows
   of one anchor are consecutive, so an anchor with all words its windows cover
   (its extent) is one row.
2. Join.  Anchors meet by hash.  An extent equal to an earlier one needs no more
   work: all its windows start earlier elsewhere.  An anchor with one extent
   only has no partial repeats.
3. Extend.  Where extents around one anchor differ, they are extended both ways
   word by word: each of their windows, as the anchor shifts through it, meets
   its equals.  Runs of matched windows are the maximal repeats.

Skew: each task first joins the anchors of its own batch and sends one row for
an extent and batch, so a passage that a third of all documents hold makes as
many rows as there are batches.  Nothing is sampled or capped, and no pairs are
made.  Extents and windows are compared by 128 bits of hash.

Defined cases: null or empty texts have no words and stay as they are; a text of
under 20 words loses nothing; rows with one id count as one document (windows at
the same start are not earlier than each other), null ids as one document before
all others; extra columns pass through untouched (a struct column is added under
a fresh name).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

_SPACE = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
WORD = np.ones(256, bool)
WORD[_SPACE] = False
FOUND = "key long, alt long, kind int, id long, tid long, lo int, hi int"
ROW = ["id", "tid", "lo", "hi"]
LOCAL, REMOTE = 1, 0


class _Words:
    """Words of a run of rows: bounds, hashes, first word of each row."""

    def __init__(self, data, off):
        self.starts, self.ends, self.first = c.words_of(data, off, WORD)
        self.data = data

    def hashes(self):
        return c.Prefix(c.LUT_A[self.data]).hash(self.starts, self.ends)


def _settle(key, alt, ids, tids, lo, hi):
    """Join the rows of one batch: which are first of their kind, which repeat an earlier one.

    Returns an Arrow batch of FOUND: first rows to be joined with other batches
    (REMOTE), and merged ranges of window starts of the others (LOCAL).
    """
    order = np.lexsort((tids, lo, ids, alt, key))
    key, alt, ids, tids, lo, hi = (x[order] for x in (key, alt, ids, tids, lo, hi))
    new = c.first_of_runs(key, alt)
    keep = np.flatnonzero(new)
    at = keep[np.cumsum(new) - 1]
    later = (ids > ids[at]) | (lo > lo[at])
    # rows of one start and id tie; each row's own text is to be looked up, so each stays
    keep = np.flatnonzero(~later & (new | (tids != np.roll(tids, 1))))
    gone = np.flatnonzero(later)
    ids_l, tids_l, lo_l, hi_l = c.merge_by_row(ids[gone], tids[gone], lo[gone], hi[gone])
    own = c.signed(c.mix(ids_l.view(np.uint64) + tids_l.view(np.uint64)))
    kind = np.repeat(np.array([REMOTE, LOCAL], np.int32), [len(keep), len(ids_l)])
    cat = np.concatenate
    columns = [cat([c.signed(key[keep]), own]), cat([c.signed(alt[keep]), own]), kind, cat([ids[keep], ids_l]), cat([tids[keep], tids_l]), cat([lo[keep], lo_l]).astype(np.int32), cat([hi[keep], hi_l]).astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "alt", "kind", *ROW])


def _seed(length: int, gram: int):
    """Anchors of each batch of (id, tid, text); lo and hi are the first and last window start."""

    def run(batches):
        for batch in batches:
            ids_all, tids_all = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            data, off = c.text_buffers(batch.column(2))
            parts = []
            for i, j, part, poff in c.chunks(data, off):
                words = _Words(part, poff)
                wh = words.hashes()
                if len(wh) < length:
                    continue
                anchor = c.window_argmin(c.kgrams(wh, gram), length - gram + 1)
                row = c.rows_of(words.first)
                n = len(anchor)
                ok = np.flatnonzero(row[:n] == row[length - 1 : length - 1 + n])
                anchor = anchor[ok]
                new = c.first_of_runs(anchor, row[ok])
                lo = ok[new]
                hi = ok[np.append(np.flatnonzero(new)[1:] - 1, len(ok) - 1)] if len(ok) else ok
                at = anchor[new]
                key = c.kgrams(wh, gram)[at]
                # the extent's content and the anchor's place in it
                alt = c.Prefix(wh).hash(lo, hi + length) ^ c.mix((at - lo).astype(np.uint64))
                r = row[lo]
                parts.append((key, alt, ids_all[i:j][r], tids_all[i:j][r], lo - words.first[r], hi - words.first[r]))
            if parts:
                yield _settle(*(np.concatenate(x) for x in zip(*parts)))

    return run


def _extend(length: int):
    """All windows of the marked extents: batches of (id, tid, text, [(lo, hi)])."""

    def run(batches):
        for batch in batches:
            ids_all, tids_all = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            data, off = c.text_buffers(batch.column(2))
            marks = batch.column(3)
            lo_all = marks.values.field("lo").to_numpy(zero_copy_only=False)
            hi_all = marks.values.field("hi").to_numpy(zero_copy_only=False)
            moff = np.asarray(marks.offsets)
            parts = []
            for i, j, part, poff in c.chunks(data, off):
                words = _Words(part, poff)
                wh = words.hashes()
                base, count = moff[i], moff[i : j + 1]
                lo, hi = lo_all[base : count[-1]].astype(np.int64), hi_all[base : count[-1]].astype(np.int64)
                r = np.repeat(np.arange(j - i), np.diff(count))
                many = hi - lo + 1
                first = np.repeat(lo - np.append(0, np.cumsum(many))[:-1], many)
                start = first + np.arange(int(many.sum()))
                r = np.repeat(r, many)
                at = words.first[r] + start
                key = c.Prefix(wh).hash(at, at + length)
                alt = c.Prefix(c.mix(wh + c.U(1))).hash(at, at + length)
                parts.append((key, alt, ids_all[i:j][r], tids_all[i:j][r], start, start))
            if parts:
                yield _settle(*(np.concatenate(x) for x in zip(*parts)))

    return run


def _apply(length: int, n_in: int):
    """Cut the ranges (last column) out of the text (column 1); append a struct."""

    def run(batches):
        for batch in batches:
            data, off = c.text_buffers(batch.column(n_in + 1))
            cut = batch.column(n_in + 2)
            nothing = cut.is_null().to_numpy(zero_copy_only=False)
            n_words, n_removed, sha, kept = [], [], [], []
            for i, j, part, poff in c.chunks(data, off):
                words = _Words(part, poff)
                whole = part.tobytes()
                for r in range(j - i):
                    a, b = int(words.first[r]), int(words.first[r + 1])
                    ws, we = words.starts[a:b], words.ends[a:b]
                    n_words.append(b - a)
                    if nothing[i + r]:
                        n_removed.append(0)
                        text = b" ".join(whole[poff[r] : poff[r + 1]].split())
                        kept.append(None)
                    else:
                        stay = np.ones(b - a + 1, np.int64)
                        stay[:] = 0
                        for x in cut[i + r].as_py():
                            stay[x["lo"]] += 1
                            stay[x["hi"] + length] -= 1
                        stay = np.cumsum(stay)[:-1] == 0
                        n_removed.append(int(b - a - stay.sum()))
                        text = b" ".join(c.strings(whole, ws[stay], we[stay]))
                        kept.append(text.decode("utf-8", "replace"))
                    sha.append(hashlib.sha256(text).hexdigest())
            made = pa.StructArray.from_arrays(
                [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())],
                names=["n_words", "n_removed", "kept_sha256", "kept_text"],
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_in], made], names=[*batch.schema.names[:n_in], "made"])

    return run


def _joined(found: DataFrame, classes: bool) -> DataFrame:
    """Join rows that agree in hash: 'gone' ranges, and with classes, 'open' extents."""
    same = Window.partitionBy("key", "alt", "kind").orderBy("id", "lo")
    place = F.when(F.col("kind") == LOCAL, 2).otherwise(F.rank().over(same))
    found = found.repartition("key").withColumn("place", place)
    if classes:
        other = F.when(F.col("kind") == REMOTE, F.col("alt"))
        around = Window.partitionBy("key")
        found = found.withColumn("many", F.min(other).over(around) != F.max(other).over(around))
        found = found.where((F.col("place") > 1) | F.col("many"))
    else:
        found = found.where(F.col("place") > 1)
    return found.select(*ROW, (F.col("place") > 1).alias("gone"))


def _by_id(rows: DataFrame, name: str) -> DataFrame:
    """The ranges of a document (id, hash of text) in one row: bounded by its length."""
    return rows.groupBy("id", "tid").agg(F.collect_list(F.struct("lo", "hi")).alias(name))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 20, gram: int = 8, out: str = "dedup") -> DataFrame:
    """All columns of ``docs`` and a struct ``out`` (n_words, n_removed, kept_sha256, kept_text).

    kept_text is null where nothing was removed (the text stays as it is);
    otherwise the kept words joined by one space.
    """
    spark = docs.sparkSession
    ws = c.Workspace(spark, "substring")
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = docs.select(c.id_key(F.col(id_col)).alias("id"), F.xxhash64(body).alias("tid"), body.alias("body"))
    first = ws.save(_joined(slim.mapInArrow(_seed(length, gram), FOUND), True), "extents")
    ws.tidy()
    open_ = _by_id(first.where(~F.col("gone")).distinct(), "marks")
    windows = slim.join(open_, ["id", "tid"]).select("id", "tid", "body", "marks").mapInArrow(_extend(length), FOUND)
    second = ws.save(_joined(windows, False), "windows")
    ws.tidy()
    names = []
    for name in ("_id", "_tid", "_body", "_cut"):
        names.append(c.fresh([*docs.columns, *names], name))
    key, tid, text, cut_name = names
    cut = _by_id(first.where("gone").unionByName(second).select(*ROW), "cut")
    cut = cut.select(F.col("id").alias(key), F.col("tid").alias(tid), F.col("cut").alias(cut_name))
    whole = docs.withColumn(key, c.id_key(F.col(id_col))).withColumn(text, body).withColumn(tid, F.xxhash64(F.col(text))).join(cut, [key, tid], "left")
    whole = whole.select(*[F.col(f"`{x}`") for x in docs.columns], key, text, cut_name)
    made = c.fresh(docs.columns, out)
    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{made}` struct<n_words:long,n_removed:long,kept_sha256:string,kept_text:string>"])
    return whole.mapInArrow(_apply(length, len(docs.columns)), kinds)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = c.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    done = dedup_substrings(docs)
    return done.select("doc_id", *(f"dedup.{x}" for x in ("n_words", "n_removed", "kept_sha256")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the repeated passages cut out of their texts; none of them goes."""
    made = c.fresh(docs.columns, "dedup")
    done = dedup_substrings(docs, out=made)
    text = F.coalesce(F.col(f"{made}.kept_text"), F.col("text"))
    return done.withColumn("text", text).withColumn("n_chars", F.when(F.col(f"{made}.kept_text").isNull(), F.col("n_chars")).otherwise(F.length("text"))).select(*docs.columns)

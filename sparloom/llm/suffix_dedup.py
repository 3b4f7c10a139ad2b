"""Suffix-array dedup: bytes of every 400-byte string that starts anywhere else.

All copies go, the first too.  Texts are UTF-8 bytes; matches never cross
documents, and strings are judged on the input.

1. Anchors.  Of the 145-byte grams that start in the first 256 places of a
   400-byte string, the string picks the rightmost least hash.  Equal strings
   pick the same one at the same distance, so they meet under its hash.  An
   anchor's extent is all the strings that pick it there: one row per about 130
   bytes.
2. Split by content.  Extents around one anchor may differ.  Strings at the
   distances of one cell (16 neighbouring distances) share a core of 385 bytes,
   so an extent is dealt as at most 16 rows, each under the hash of its core; what
   is left of it are up to 15 bytes on either side.  The rows are split once
   more, into cells of two distances: a core of 399 bytes and a byte on either
   side.  Strings that are equal have equal cores, so they stay together, and a
   group ends with at most 257 * 257 kinds, however many documents hold it.
3. Suffix array.  The kinds of a group, each one entry with its count, are
   written as byte, core, byte and sorted by linear grouping (see suffix_array);
   neighbours in suffix order that agree in a whole string are repeats.

The same steps are taken at every size of a group; a step sees only the rows of
groups that hold different kinds (the rest is settled by its count).

Skew: every task joins the equal rows of its own batch first, so a hot passage
sends one row a batch.  Nothing is capped or sampled, and no group is gathered
before step 3, where its size is bounded.

Defined cases: null texts are empty; texts under 400 bytes lose nothing; a
repeated row is another document with the same text; null ids are kept; where a
removed run parts a character, the kept bytes are exact and ``kept_text`` drops
the broken halves of that character; further columns pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c
from .suffix_array import suffix_array

LENGTH, GRAM, CELL = 400, 145, 16
REACH = LENGTH - GRAM + 1
SIDE = CELL - 1
#: key, more: two hashes of what a group has in common (of extents, which are no entries yet, only one); alt: of a row's whole content.
FOUND = "key long, more long, alt long, kind int, many int, id long, tid long, lo int, hi int, at int, sides binary"
REMOTE, LOCAL = 0, 1
ROW = ["id", "tid", "lo", "hi"]
#: Entries that one suffix array takes, unless a single group has more.
ENTRIES = 1 << 15


def _settle(key, more, alt, many, ids, tids, lo, hi, at, sides):
    """Join the rows of one batch: one REMOTE row for each kind with its count, LOCAL ranges of those counted twice or more."""
    order = np.lexsort((lo, tids, ids, alt, key))
    key, more, alt, many, ids, tids, lo, hi, at = (x[order] for x in (key, more, alt, many, ids, tids, lo, hi, at))
    new = np.flatnonzero(c.first_of_runs(key, alt))
    if not len(new):
        return None
    size = np.diff(np.append(new, len(key)))
    total = np.minimum(np.add.reduceat(many, new), 2)
    gone = np.flatnonzero(np.repeat(size, size) > 1)
    ids_l, tids_l, lo_l, hi_l = c.merge_by_row(ids[gone], tids[gone], lo[gone], hi[gone])
    own = c.signed(c.mix(ids_l.view(np.uint64) + tids_l.view(np.uint64)))
    cat = np.concatenate
    zero = np.zeros(len(own), np.int64)
    kind = np.repeat([REMOTE, LOCAL], [len(new), len(own)])
    long = [cat([c.signed(x[new]), y]) for x, y in ((key, own), (more, zero), (alt, own))]
    places = [cat([x[new], y]) for x, y in ((ids, ids_l), (tids, tids_l), (lo, lo_l), (hi, hi_l), (at, zero))]
    small = [pa.array(x.astype(np.int32)) for x in (kind, cat([total, zero]))]
    said = pa.array([*(sides[k] for k in order[new].tolist()), *[b""] * len(own)] if sides is not None else [b""] * len(kind), pa.binary())
    columns = [*map(pa.array, long), *small, *map(pa.array, places[:2]), *(pa.array(x.astype(np.int32)) for x in places[2:]), said]
    return pa.RecordBatch.from_arrays(columns, names=["key", "more", "alt", "kind", "many", *ROW, "at", "sides"])


def _seed(batches):
    """Extents of batches of (id, tid, text)."""
    for batch in batches:
        ids_all, tids_all = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        data, off = c.text_buffers(batch.column(2))
        parts = []
        for i, j, part, poff in c.chunks(data, off):
            n = len(part)
            if n < LENGTH:
                continue
            prefix = c.Prefix(c.LUT_A[part])
            at = np.arange(n - GRAM + 1)
            grams = prefix.hash(at, at + GRAM)
            pick = c.window_argmin((grams >> c.U(32)).astype(np.uint32), REACH)
            size = np.diff(poff)
            long_rows = np.flatnonzero(size >= LENGTH)
            many = size[long_rows] - LENGTH + 1
            row = np.repeat(long_rows, many)
            start = np.repeat(poff[long_rows] - np.append(0, np.cumsum(many))[:-1], many) + np.arange(int(many.sum()))
            chosen = pick[start]
            new = np.flatnonzero(c.first_of_runs(chosen, row))
            if not len(new):
                continue
            lo, hi = start[new], start[np.append(new[1:] - 1, len(start) - 1)]
            anchor, r = chosen[new], row[new]
            alt = prefix.hash(lo, hi + LENGTH) ^ c.mix((anchor - lo).astype(np.uint64))
            parts.append((grams[anchor], alt, ids_all[i:j][r], tids_all[i:j][r], lo - poff[r], hi - poff[r], anchor - poff[r]))
        if parts:
            key, alt, *places = (np.concatenate(x) for x in zip(*parts))
            yield _settle(key, np.zeros_like(key), alt, np.ones(len(key), np.int64), *places, None)


def _cells(batches):
    """Extents of batches of (id, tid, text, marks) as rows under the hash of their cores.

    A cell holds the distances a .. a + SIDE from a string's start to its anchor.
    """
    for batch in batches:
        ids_all, tids_all = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        data, off = c.text_buffers(batch.column(2))
        marks = batch.column(3)
        moff = np.asarray(marks.offsets)
        fields = [marks.values.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("lo", "hi", "at", "many")]
        parts, sides = [], []
        for i, j, part, poff in c.chunks(data, off):
            lo, hi, at, many = (x[moff[i] : moff[j]] for x in fields)
            r = np.repeat(np.arange(j - i), np.diff(moff[i : j + 1]))
            if not len(r):
                continue
            a, b = c.Prefix(c.LUT_A[part]), c.Prefix(c.LUT_B[part])
            near, far = at - hi, at - lo
            first = near // CELL
            times = far // CELL - first + 1
            take = np.repeat(np.arange(len(r)), times)
            cell = np.repeat(first - np.append(0, np.cumsum(times))[:-1], times) + np.arange(len(take))
            base, own, row = cell * CELL, poff[r][take], r[take]
            x, y = np.maximum(near[take], base), np.minimum(far[take], base + SIDE)
            p = at[take]
            core, end = own + p - base, own + p - base - SIDE + LENGTH
            place = c.mix((cell + 1).astype(np.uint64))
            key, more = a.hash(core, end) ^ place, b.hash(core, end) ^ place
            whole = c.mix(b.hash(own + p - y, own + p - x + LENGTH) ^ c.mix((y * REACH + x).astype(np.uint64)))
            parts.append((key, more, whole, many[take], ids_all[i:j][row], tids_all[i:j][row], p - y, p - x, y - base))
            bytes_ = part.tobytes()
            # the left side is kept from the core outward
            sides += [bytes([v - u]) + bytes_[u:v][::-1] + bytes_[e:z] for u, v, e, z in zip((own + p - y).tolist(), core.tolist(), end.tolist(), (own + p - x + LENGTH).tolist())]
        if parts:
            yield _settle(*(np.concatenate(x) for x in zip(*parts)), sides)


def _pairs(batches):
    """Rows of ``_cells`` split into cells of two distances: a byte or none (256) on either side."""
    for batch in batches:
        if not len(batch):
            continue
        key, more, many, ids, tids, lo, most = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("key", "more", "many", "id", "tid", "lo", "at"))
        raw = batch.column("sides").to_pylist()
        n = len(raw)
        left, right = np.zeros((n, SIDE), np.int64), np.zeros((n, SIDE), np.int64)
        least = np.zeros(n, np.int64)
        flat = np.frombuffer(b"".join(x[1 : 1 + x[0]].ljust(SIDE, b"\0") + x[1 + x[0] :].ljust(SIDE, b"\0") for x in raw), np.uint8).reshape(n, 2 * SIDE)
        left[:], right[:] = flat[:, :SIDE], flat[:, SIDE:]
        least = SIDE - (np.array([len(x) - 1 - x[0] for x in raw], np.int64))  # strings stand at the distances least .. most of the cell
        lut_a, lut_b = c.LUT_A, c.LUT_B

        def run(lut, side):
            sums = [np.zeros(n, np.uint64)]
            for k in range(SIDE):
                sums.append(c.mix(sums[-1] * c._P + lut[side[:, k]]))
            return sums

        la, ra, lb, rb = run(lut_a, left), run(lut_a, right), run(lut_b, left), run(lut_b, right)
        parts, sides = [], []
        for b in range(0, CELL, 2):
            ok = np.flatnonzero((least <= b + 1) & (most >= b))
            if not len(ok):
                continue
            place = c.U(b + 1)
            k3 = c.mix(c.mix(key[ok].view(np.uint64) * c._P + la[b][ok]) * c._P + ra[SIDE - 1 - b][ok] + place)
            m3 = c.mix(c.mix(more[ok].view(np.uint64) * c._P + lb[b][ok]) * c._P + rb[SIDE - 1 - b][ok] + place)
            outer = np.where(most[ok] > b, left[ok, b], 256)
            inner = np.where(least[ok] <= b, right[ok, SIDE - 1 - b], 256)
            alt = c.mix(m3 + (outer * 257 + inner).astype(np.uint64) * c._P)
            from_, to = lo[ok] + most[ok] - np.minimum(most[ok], b + 1), lo[ok] + most[ok] - np.maximum(least[ok], b)
            parts.append((k3, m3, alt, many[ok].astype(np.int64), ids[ok], tids[ok], from_.astype(np.int64), to.astype(np.int64), outer * 257 + inner))
        if parts:
            made = _settle(*(np.concatenate(x) for x in zip(*parts)), None)
            if made is not None:
                yield made


def repeated(cores: list[int], outer: list[int], inner: list[int], many: list[int]) -> list[tuple[int, int]]:
    """(entry, 1 for the string that begins with the outer byte or 0 for the one at the core) of all repeated strings.

    An entry reads outer byte, core, inner byte, where 256 stands for no byte.
    """
    symbol = {core: 257 + k for k, core in enumerate(dict.fromkeys(cores))}
    text: list[int] = []
    begins: list[tuple[int, int] | None] = []
    for k, (core, o, i) in enumerate(zip(cores, outer, inner)):
        if o < 256:
            text.append(o)
            begins.append((k, 1))
        text.append(symbol[core])
        begins.append((k, 0) if i < 256 else None)
        if i < 256:
            text.append(i)
            begins.append(None)
    found, run, last = [], [], None
    for s in [*suffix_array(text), None]:
        own = None if s is None else begins[s]
        if s is not None and own is None:
            continue
        string = None if s is None else (text[s], text[s + 1])
        if string != last:
            if len(run) > 1 or run and many[run[0][0]] > 1:
                found += run
            run, last = [], string
        if own is not None:
            run.append(own)
    return found


def _arrays(batches):
    """Entries sorted by (key, more): the ranges that suffix arrays over whole groups find repeated."""
    held = None

    def done(table):
        key, more, ids, tids, lo, hi, at, many = (table.column(x).to_numpy() for x in ("key", "more", *ROW, "at", "many"))
        group = np.cumsum(c.first_of_runs(key, more)) - 1
        found = np.array(repeated(group.tolist(), (at // 257).tolist(), (at % 257).tolist(), many.tolist()), np.int64).reshape(-1, 2)
        k, first = found[:, 0], found[:, 1] == 1
        place = np.where(first, lo[k], hi[k])
        made = c.merge_by_row(ids[k], tids[k], place, place)
        return pa.RecordBatch.from_arrays([pa.array(made[0]), pa.array(made[1]), pa.array(made[2].astype(np.int32)), pa.array(made[3].astype(np.int32))], names=ROW)

    for batch in batches:
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if len(held) < ENTRIES:
            continue
        keys = held.column("key").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
        if cut:
            yield done(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and len(held):
        yield done(held)


def _apply(n_in: int):
    def run(batches):
        for batch in batches:
            data, off = c.text_buffers(batch.column(n_in + 1))
            cut = batch.column(n_in + 2).to_pylist()
            sizes, removed, spans, sha, kept = [], [], [], [], []
            for r, ranges in enumerate(cut):
                text = data[off[r] : off[r + 1]]
                sizes.append(len(text))
                if ranges:
                    lo = np.array([x["lo"] for x in ranges], np.int64)
                    hi = np.array([x["hi"] for x in ranges], np.int64) + LENGTH
                    lo, hi = c.merge_ranges(lo, hi)
                    ends = np.append(lo, len(text))
                    left = b"".join(text[a:b].tobytes() for a, b in zip(np.append(0, hi).tolist(), ends.tolist()))
                    removed.append(int((hi - lo).sum()))
                    spans.append(len(lo))
                    kept.append(left.decode("utf-8", "ignore"))
                else:
                    left = text.tobytes()
                    removed.append(0)
                    spans.append(0)
                    kept.append(None)
                sha.append(hashlib.sha256(left).hexdigest())
            made = pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())],
                names=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"],
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_in], made], names=[*batch.schema.names[:n_in], "made"])

    return run


def _counted(found: DataFrame) -> DataFrame:
    """Rows of one kind over all batches: ``gone`` if counted twice, ``first`` on the one that stands for its kind."""
    same = Window.partitionBy("key", "alt", "kind")
    remote = F.col("kind") == REMOTE
    rows = found.repartition("key", "alt").withColumn("place", F.row_number().over(same.orderBy("id", "tid", "lo"))).withColumn("total", F.sum("many").over(same))
    return rows.select("key", "more", "alt", F.least("total", F.lit(2)).cast("int").alias("many"), *ROW, "at", "sides", (~remote | (F.col("total") > 1)).alias("gone"), (remote & (F.col("place") == 1)).alias("first"))


def _open(rows: DataFrame) -> DataFrame:
    """One row for each kind of the groups that hold several; a group is never gathered."""
    kinds = rows.where("first")
    several = kinds.groupBy("key").agg(F.min("alt").alias("a"), F.max("alt").alias("b")).where("a <> b").select("key")
    return kinds.join(several, "key", "left_semi")


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "dedup") -> DataFrame:
    """All columns of ``docs`` and a struct ``out`` (n_bytes, n_removed, n_spans, kept_sha256, kept_text).

    kept_text is null where nothing was removed.
    """
    ws = c.Workspace(docs.sparkSession, "suffix")
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = docs.select(c.id_key(F.col(id_col)).alias("id"), F.xxhash64(body).alias("tid"), body.alias("body"))
    extents = ws.save(_counted(slim.mapInArrow(_seed, FOUND)), "extents")
    ws.tidy()
    marks = _open(extents).groupBy("id", "tid").agg(F.collect_list(F.struct("lo", "hi", "at", "many")).alias("marks"))
    marked = slim.dropDuplicates(["id", "tid"]).join(marks, ["id", "tid"]).select("id", "tid", "body", "marks")
    cells = ws.save(_counted(marked.mapInArrow(_cells, FOUND)), "cells")
    ws.tidy()
    pairs = ws.save(_counted(_open(cells).mapInArrow(_pairs, FOUND)), "pairs")
    entries = _open(pairs).select("key", "more", *ROW, "at", "many").repartition("key").sortWithinPartitions("key", "more")
    sorted_ = ws.save(entries.mapInArrow(_arrays, "id long, tid long, lo int, hi int"), "sorted")
    ws.tidy()
    gone = sorted_
    for rows in (extents, cells, pairs):
        gone = gone.unionByName(rows.where("gone").select(*ROW))
    names = []
    for name in ("_id", "_body", "_tid", "_cut"):
        names.append(c.fresh([*docs.columns, *names], name))
    key, text, tid, cut_name = names
    cut = gone.groupBy(F.col("id").alias(key), F.col("tid").alias(tid)).agg(F.collect_list(F.struct("lo", "hi")).alias(cut_name))
    whole = docs.withColumn(key, c.id_key(F.col(id_col))).withColumn(text, body).withColumn(tid, F.xxhash64(F.col(text))).join(cut, [key, tid], "left")
    whole = whole.select(*[F.col(f"`{x}`") for x in docs.columns], key, text, cut_name)
    made = c.fresh(docs.columns, out)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{made}` struct<n_bytes:long,n_removed:long,n_spans:long,kept_sha256:string,kept_text:string>"])
    return whole.mapInArrow(_apply(len(docs.columns)), schema)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_bytes(c.read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", *(f"dedup.{x}" for x in ("n_bytes", "n_removed", "n_spans", "kept_sha256")))

"""Near copies of the pipeline: 5-word shingles, Jaccard similarity of ``ALIKE`` or more.

Two texts at 0.8 differ in some 39 bits of a 256-bit simhash of their shingles, far
from the two bits of the digest query, so no bytes of it are surely equal and its buckets
cannot deal the fingerprints out.  Minhash bands do: texts that agree in all ``ROWS``
minima of one of ``BANDS`` bands meet in a bucket (a pair at 0.8 does with probability
0.9999).  A bucket is searched twice, and every link is checked on the shingle sets.

1. Star: each class of the bucket with the class nearest to the bucket's majority of bits.
   Copies of one text lie around it, so most links are found by a row for each class.
2. Trie: fingerprints of buckets that still hold several components are joined
   with themselves by the binary trie walk (simhash.trie_pairs) within ``BUDGET`` differing
   bits; a pair of classes of different components is checked where it is met, and only
   links that join components go out.  No list of pairs is ever written.

Texts of equal shingle sets are one class first, so exact copies make no pairs.  A
bucket of more than ``BLOCK`` classes is dealt in blocks, and the trie walk takes tiles of
two blocks, so a task holds no more whatever the bucket's size.

Defined cases: null and blank texts have no shingles and are one class; a text of
under five words is one shingle; null ids link too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c
from .components import components
from .decontaminate import LOWER
from .trie import Forest, trie_pairs

WIDTH, ALIKE = 5, 0.8
BANDS, ROWS = 24, 5
#: Words of a fingerprint. Bits in which a pair at ALIKE may differ: 38.8 of 256 are expected, with deviation 5.7.
WORDS, BUDGET = 4, 64
#: Classes of a bucket that one star or tile holds.
BLOCK = 2048
_SOLID = np.ones(256, bool)
_SOLID[list(b" \t\n\r\v\f")] = False
_DRAW = np.random.default_rng(20240608)
_XOR = _DRAW.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_TIMES = _DRAW.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SALTS = _DRAW.integers(0, 1 << 63, WORDS, dtype=np.uint64)
PRINT = [f"f{w}" for w in range(WORDS)]
_KEYED = f"cls long, {', '.join(f'{x} long' for x in PRINT)}, keys array<long>"


def shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, ordered."""
    low = LOWER[data]
    starts, ends, first = c.words_of(low, off, _SOLID)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    wh = c.Prefix(c.LUT_A[low]).hash(starts, ends)
    row, h = c.rows_of(first), c.kgrams(wh, WIDTH)
    n = len(h)
    whole = np.flatnonzero(row[:n] == row[WIDTH - 1 : WIDTH - 1 + n])
    size = np.diff(first)
    few = np.flatnonzero((size > 0) & (size < WIDTH))
    rows = np.concatenate([row[whole], few])
    h = np.concatenate([h[whole], c.Prefix(wh).hash(first[few], first[few + 1])])
    order = np.lexsort((h, rows))
    rows, h = rows[order], h[order]
    new = c.first_of_runs(rows, h)
    return rows[new], h[new]


def fingerprints(rows: np.ndarray, h: np.ndarray) -> np.ndarray:
    """(rows with shingles, WORDS): the bits set in over half of a row's hashes, ``rows`` sorted."""
    at = np.flatnonzero(c.first_of_runs(rows))
    size = np.diff(np.append(at, len(rows)))
    made = np.zeros((len(at), WORDS), np.uint64)
    for w in range(WORDS):
        bits = np.unpackbits(c.mix(h ^ _SALTS[w]).view(np.uint8).reshape(-1, 8), axis=1)
        many = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
        made[:, w] = np.packbits(2 * many > size[:, None], axis=1).view(np.uint64)[:, 0]
    return made


def sketches(rows: np.ndarray, h: np.ndarray, n: int):
    """(cls, fingerprint, keys) of ``n`` rows; class 0 and no keys for rows without shingles."""
    cls, prints, keys = np.zeros(n, np.uint64), np.zeros((n, WORDS), np.uint64), np.zeros((n, BANDS), np.uint64)
    if not len(rows):
        return cls, prints, keys
    at = np.flatnonzero(c.first_of_runs(rows))
    have = rows[at]
    size = np.diff(np.append(at, len(rows))).astype(np.uint64)
    cls[have] = np.maximum(c.mix(np.add.reduceat(c.mix(h), at) + size), c.U(1))
    prints[have] = fingerprints(rows, h)
    short = (h >> c.U(32)).astype(np.uint32)
    for band in range(BANDS):
        made = np.full(len(at), band + 1, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            made = c.mix(made * c._P + np.minimum.reduceat((short ^ _XOR[k]) * _TIMES[k], at))
        keys[have, band] = made
    return cls, prints, keys


def _prints(batches):
    """(id, body, tid) to (id, tid, cls, fingerprint, keys)."""
    for batch in batches:
        data, off = c.text_buffers(batch.column(1))
        for i, j, part, poff in c.chunks(data, off):
            cls, prints, keys = sketches(*shingles(part, poff), j - i)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * BANDS), pa.array(c.signed(keys).ravel()))
            made = [pa.array(c.signed(np.ascontiguousarray(x))) for x in (cls, *prints.T)]
            yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(2)[i:j], *made, lists], names=["id", "tid", "cls", *PRINT, "keys"])


def _sets(batches):
    """(body) to (cls, set)."""
    for batch in batches:
        data, off = c.text_buffers(batch.column(0))
        for i, j, part, poff in c.chunks(data, off):
            rows, h = shingles(part, poff)
            cls, _, _ = sketches(rows, h, j - i)
            ends = np.searchsorted(rows, np.arange(j - i + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(c.signed(cls)), pa.ListArray.from_arrays(pa.array(ends), pa.array(c.signed(h)))], names=["cls", "set"])


def star(prints: np.ndarray) -> tuple[int, np.ndarray]:
    """(the place nearest to the majority of bits, the others within BUDGET of it)."""
    bits = np.unpackbits(prints.view(np.uint8), axis=1)
    middle = np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(prints)).view(np.uint64)
    centre = int(np.bitwise_count(prints ^ middle).sum(axis=1).argmin())
    near = np.bitwise_count(prints ^ prints[centre]).sum(axis=1) <= BUDGET
    near[centre] = False
    return centre, np.flatnonzero(near)


def _grouped(work):
    """Rows sorted by (key, block): ``work`` on the rows of each pair of both."""

    def run(batches):
        held = None

        def done(table):
            cuts = np.append(np.flatnonzero(c.first_of_runs(table.column("key").to_numpy(), table.column("block").to_numpy())), len(table))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if b - a > 1:
                    yield from work(table.slice(a, b - a))

        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if not len(held):
                continue
            key, block = held.column("key").to_numpy(), held.column("block").to_numpy()
            cut = int(np.flatnonzero(c.first_of_runs(key, block))[-1])  # the last group may go on
            if cut:
                yield from _joined(done(held.slice(0, cut)))
                held = held.slice(cut)
        if held is not None and len(held):
            yield from _joined(done(held))

    return run


def _joined(links):
    """Links of many groups in few batches."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for a, b in links:
        held.append((a, b))
        if len(held) >= 4096:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(held):
    a, b = (np.concatenate(x) for x in zip(*held))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _prints_of(rows: pa.Table) -> np.ndarray:
    return np.stack([rows.column(x).to_numpy().view(np.uint64) for x in PRINT], axis=1)


def _stars(rows: pa.Table):
    cls = rows.column("cls").to_numpy()
    centre, near = star(_prints_of(rows))
    if len(near):
        yield np.full(len(near), cls[centre]), cls[near]


def _walks(rows: pa.Table):
    """Links between components of one tile, each checked on the shingle sets."""
    cls, sides = rows.column("cls").to_numpy(), rows.column("side").to_numpy()
    number = {root: k for k, root in enumerate(dict.fromkeys(rows.column("root").to_pylist()))}
    root = np.array([number[x] for x in rows.column("root").to_pylist()])
    if len(number) < 2:
        return
    forest, sets, found = Forest(len(number)), {}, []
    column = rows.column("set").combine_chunks()

    def shingles_of(k: int) -> frozenset:
        if k not in sets:
            sets[k] = frozenset(column[k].as_py())
        return sets[k]

    for x, y in trie_pairs(_prints_of(rows), BUDGET, root):
        for a, b in zip(x.tolist(), y.tolist()):
            if forest.find(root[a]) == forest.find(root[b]) or sides[a] == sides[b] != -1:
                continue
            one, two = shingles_of(a), shingles_of(b)
            both = len(one & two)
            if both >= ALIKE * (len(one) + len(two) - both):
                forest.join(root[a], root[b])
                found.append((cls[a], cls[b]))
    if found:
        yield tuple(np.array(x) for x in zip(*found))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tid, component, stays): one row per row of ``docs``.

    ``stays`` marks the document that stands for its component: that with the least id
    (null ids last), then the least hash of its text.
    """
    ws = c.Workspace(docs.sparkSession, "near-copies")
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = docs.select(F.col(id_col).cast("long").alias("id"), body.alias("body"), F.xxhash64(body).alias("tid"))
    prints = ws.save(slim.mapInArrow(_prints, f"id long, tid long, {_KEYED}"), "prints")
    own = F.struct(F.col("id").isNull().alias("unnamed"), F.col("id"), F.col("tid"))
    classes = ws.save(prints.groupBy("cls").agg(F.min("id").alias("least"), F.min(own).alias("first"), F.min(F.struct(c.id_key(F.col("id")).alias("key"), "tid")).alias("of")), "classes")
    keyed = prints.where("cls <> 0").dropDuplicates(["cls"]).select("cls", *PRINT, F.explode("keys").alias("key"))
    many = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    met = ws.save(keyed.join(many, "key").withColumn("blocks", F.ceil(F.col("many") / BLOCK).cast("int")).withColumn("block", F.pmod(F.col("cls"), F.col("blocks")).cast("int")), "met")
    ws.tidy()

    def sets_of(ends: DataFrame, name: str) -> DataFrame:
        # one document of each class, so the copies of a text stay where they are
        owners = classes.join(ends, "cls", "left_semi").select("of.key", "of.tid")
        texts = slim.select(c.id_key(F.col("id")).alias("key"), "tid", "body").join(owners, ["key", "tid"], "left_semi").dropDuplicates(["key", "tid"]).select("body")
        return ws.save(texts.mapInArrow(_sets, "cls long, set array<long>"), name)

    stars = ws.save(met.repartition("key", "block").sortWithinPartitions("key", "block").mapInArrow(_grouped(_stars), "a long, b long").distinct(), "stars")
    sets = sets_of(stars.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "star-sets")
    side = lambda end: sets.select(F.col("cls").alias(end), F.col("set").alias(f"set_{end}"))
    both = stars.join(side("a"), "a").join(side("b"), "b").select("a", "b", F.size("set_a").alias("n"), F.size("set_b").alias("m"), F.size(F.array_intersect("set_a", "set_b")).alias("i"))
    links = ws.save(both.where(F.col("i") >= ALIKE * (F.col("n") + F.col("m") - F.col("i"))).select("a", "b"), "links")
    roots = components(links, ws).withColumnRenamed("id", "cls")

    rooted = ws.save(met.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")), "rooted")
    several = rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
    rooted = rooted.join(several, "key", "left_semi")
    # a tile holds two blocks (i, j); the pairs within a block belong to the tile (i, i)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = rooted.withColumn("other", other).withColumn("side", F.when(F.col("block") == F.col("other"), -1).otherwise(F.col("block")))
    tiles = tiles.withColumn("block", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"))
    tiles = tiles.select("key", "block", "side", "cls", "root", *PRINT)
    walked = tiles.join(sets_of(rooted.select("cls").distinct(), "walk-sets"), "cls").repartition("key", "block").sortWithinPartitions("key", "block")
    more = ws.save(walked.mapInArrow(_grouped(_walks), "a long, b long").distinct(), "walks")
    roots = components(links.unionByName(more), ws, "cc2").withColumnRenamed("id", "cls")
    ws.tidy()
    labelled = classes.join(roots, "cls", "left").select("cls", "least", "first", F.coalesce("root", "cls").alias("root"))
    stands = labelled.groupBy("root").agg(F.min("least").alias("component"), F.min("first").alias("stands"))
    named = ws.save(labelled.select("cls", "root").join(stands, "root").select("cls", "component", "stands"), "named")
    ws.drop("classes", "met", "stars", "star-sets", "links", "rooted", "walk-sets", "walks")
    return prints.select("id", "tid", "cls").join(named, "cls").select("id", "tid", "component", (own == F.col("stands")).alias("stays"))

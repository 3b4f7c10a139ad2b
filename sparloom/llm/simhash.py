"""SimHash near-dedup: fingerprints joined by a binary trie walked in pairs.

Fingerprints are 64 bits; bit i is set if it is set in over half of the XXH64
(seed 42) hashes of a text's 3-word shingles.  Two fingerprints link at two or
fewer differing bits; a component is what links reach.

How links are found: equal fingerprints are one row first (a third of all
documents may share one).  The 64 bits fall into eight bytes; two differing
bits leave at least six bytes equal, so fingerprints that agree in some six of
eight bytes (28 choices) meet in one bucket.  Within a bucket a binary trie is
walked against itself: node pairs go down together, differing bits add up, and a
pair is dropped when they exceed two.  A bucket holds distinct fingerprints that
agree in 48 bits, so no bucket can exceed 65,536 of them however many documents
are alike, and its links go out as a spanning forest, never as all pairs.

Defined cases: null and blank texts have no words and fingerprint zero; a text
of under three words is one shingle; repeated rows and ties link like any other
documents; null ids link too, and a component's id is its least non-null id
(null if it has none).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .components import components
from .near_copies import near_groups
from .trie import trie_join

BUDGET = 2
_MASKS = [
    np.uint64(sum(0xFF << (8 * b) for b in kept))
    for kept in combinations(range(8), 6)
]


def fingerprint_hashes(text: bytes, width: int = 3, seed: int = 42) -> list[int]:
    """XXH64 of each shingle of the lower-cased words."""
    words = text.lower().split()
    if not words:
        return []
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = len(words) - width + 1
    return [digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[width - 1 :].tolist())]


def majority(hashes: list[int]) -> int:
    """The bits set in over half of the hashes; 0 for none."""
    if not hashes:
        return 0
    n, count = len(hashes), np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = np.array(hashes[i : i + (1 << 16)], np.uint64)
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        count += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(count * 2 > n).tobytes(), "big")


def _fingerprints(width: int):
    def run(batches):
        for batch in batches:
            data, off = c.text_buffers(batch.column(1))
            whole = data.data if len(data) else b""
            made = [majority(fingerprint_hashes(bytes(whole[a:b]), width)) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            made = np.array(made, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(made)], names=["id", "tid", "fp"])

    return run


def _bucket_keys(batches):
    """Each distinct fingerprint under its 28 keys: the kept bytes, and which they are."""
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        keys = [c.mix((fps & m) ^ c.U(c.mix(np.array([i + 1], np.uint64))[0])) for i, m in enumerate(_MASKS)]
        yield pa.RecordBatch.from_arrays([pa.array(c.signed(np.concatenate(keys))), pa.array(np.tile(c.signed(fps), len(_MASKS)))], names=["key", "fp"])


def _buckets(batches):
    """Rows sorted by (key, fp): links of each bucket of two or more."""
    key_held, fp_held = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def links(keys, fps):
        if not len(keys):
            return None
        new = np.flatnonzero(c.first_of_runs(keys))
        size = np.diff(np.append(new, len(keys)))
        found = []
        for at, n in zip(new[size > 1].tolist(), size[size > 1].tolist()):
            values = np.sort(fps[at : at + n].view(np.uint64)).tolist()
            found += trie_join(values, BUDGET)
        if not found:
            return None
        pairs = np.array(found, np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    for batch in batches:
        key_held = np.concatenate([key_held, batch.column(0).to_numpy()])
        fp_held = np.concatenate([fp_held, batch.column(1).to_numpy()])
        if not len(key_held):
            continue
        cut = int(np.searchsorted(key_held, key_held[-1]))  # the last bucket may go on
        if (out := links(key_held[:cut], fp_held[:cut])) is not None:
            yield out
        key_held, fp_held = key_held[cut:], fp_held[cut:]
    if (out := links(key_held, fp_held)) is not None:
        yield out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, tid, fp long) of every row; tid is a hash of the text."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), body.alias("body"), F.xxhash64(body).alias("tid")).mapInArrow(_fingerprints(width), "id long, tid long, fp long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, tid, fp long, component, stays): one row per row of ``docs``.

    ``stays`` marks the document that stands for its component: that with the least id
    (null ids last), then the least hash of its text.
    """
    ws = c.Workspace(docs.sparkSession, "simhash")
    prints = ws.save(fingerprints(docs, id_col, text_col, width), "prints")
    own = F.struct(F.col("id").isNull().alias("unnamed"), F.col("id"), F.col("tid"))
    classes = ws.save(prints.groupBy("fp").agg(F.min("id").alias("least"), F.min(own).alias("first")), "classes")
    keyed = classes.select("fp").mapInArrow(_bucket_keys, "key long, fp long")
    links = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_buckets, "a long, b long")
    roots = components(links, ws).withColumnRenamed("id", "fp")
    ws.tidy()
    labelled = classes.join(roots, "fp", "left").select("fp", "least", "first", F.coalesce("root", "fp").alias("root"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component"), F.min("first").alias("stands"))
    named = ws.save(labelled.select("fp", "root").join(least, "root").select("fp", "component", "stands"), "named")
    return prints.join(named, "fp").select("id", "tid", "fp", "component", (own == F.col("stands")).alias("stays"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(c.read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays; a repeated row is the same document.

    The pipeline's near copies are texts of like 5-word shingles (see ``near_copies``);
    the two bits over 3-word shingles are the digest query's alone.
    """
    ws = c.Workspace(spark, "simhash-stage")
    groups = ws.save(near_groups(docs).select(c.id_key(F.col("id")).alias("key"), "tid", "stays"), "groups")
    key, tid = c.fresh(docs.columns, "_key"), c.fresh(docs.columns, "_tid")
    gone = groups.where("not stays").select(F.col("key").alias(key), F.col("tid").alias(tid)).distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kept = docs.withColumns({key: c.id_key(F.col("doc_id")), tid: F.xxhash64(text)}).join(gone, [key, tid], "left_anti")
    if groups.where("stays").groupBy("key", "tid").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates([key, tid])
    return kept.select(*docs.columns)

"""Shared pieces of the training-data operators.

* ``Workspace`` cuts lineage through Parquet tables in the folder every
  executor sees (``spark.checkpoint.dir``), so a lost executor costs only the
  tasks it ran.
* The hashing kit works on whole Arrow buffers with numpy: a text column is one
  byte array plus offsets, so words, k-grams and windows of thousands of
  documents are hashed without a Python loop per word.

All hashes are 64-bit sums of random byte values times powers of an odd number
modulo 2**64 (a segment's hash is a difference of prefix sums), then mixed.
Grouping uses two such hashes (128 bits) wherever a collision would change a
result.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_LONG = -(1 << 63)
CHUNK_BYTES = 1 << 20


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the session; where it is unset, an own one in local mode only."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = f"/tmp/checkpoints/sparloom-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


class Workspace:
    """Parquet tables of one operator run, in the shared folder."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no returned plan reads."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def tidy(self) -> None:
        """Let Spark delete shuffle files of finished steps now."""
        import gc

        gc.collect()
        self.spark._jvm.System.gc()


def fresh(df_columns, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df_columns}
    while name.lower() in taken:
        name += "_"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_key(column) -> F.col:
    """An ordering key for an id: null ids count as one document before all."""
    return F.coalesce(column.cast("long"), F.lit(MIN_LONG))


# --------------------------------------------------------------------------
# Arrow text buffers


def text_buffers(array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty texts."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = pc.fill_null(array, "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, off, data = array.buffers()
    if len(array) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    off = np.frombuffer(off, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, off


def chunks(data: np.ndarray, off: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``size`` bytes: (first row, end row, bytes, offsets)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def strings(buffer: bytes, starts, ends) -> list[bytes]:
    return [buffer[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


# --------------------------------------------------------------------------
# hashing

U = np.uint64
_P = U(0x9E3779B97F4A7C15 | 1)
_P_INV = U(pow(int(_P), -1, 1 << 64))
_BYTES = np.random.default_rng(20240607).integers(0, 1 << 63, 512, dtype=np.uint64) * U(2) + U(1)
LUT_A, LUT_B = _BYTES[:256], _BYTES[256:]
_TABLES: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES.get("p", ())) < n:
        size = max(n, CHUNK_BYTES + 2)
        for name, base in (("p", _P), ("q", _P_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _TABLES[name] = np.cumprod(steps, dtype=np.uint64)
    return _TABLES["p"], _TABLES["q"]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(32))
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(29)
    h *= U(0xA0761D6478BD642F)
    h ^= h >> U(32)
    return h


class Prefix:
    """Prefix sums that give the hash of any segment of a value sequence."""

    def __init__(self, values: np.ndarray):
        p, self.inverse = _powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * p[: len(values)], out=self.sums[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def words_of(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row + total) of the maximal runs of word bytes."""
    n = len(data)
    flag = np.zeros(n + 2, bool)
    flag[1:-1] = is_word[data]
    edge = np.zeros(n + 1, bool)
    inner = off[(off > 0) & (off < n)]
    edge[inner] = True
    here, before, after = flag[1:-1], flag[:-2], flag[2:]
    starts = np.flatnonzero(here & (~before | edge[:-1]))
    ends = np.flatnonzero(here & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def rows_of(first: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def kgrams(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive values (rows not regarded)."""
    m = len(values) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = values[:m].copy()
    for j in range(1, k):
        h *= _P
        h += values[j : j + m]
    return mix(h)


def window_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the rightmost least hash in h[i : i + w], for each whole window."""
    if len(h) < w:
        return np.zeros(0, np.int64)
    best, at, span = h, np.arange(len(h)), 1
    while span < w:
        step = min(span, w - span)
        left, right = best[:-step], best[step:]
        take = right <= left
        best, at = np.where(take, right, left), np.where(take, at[step:], at[:-step])
        span += step
    return at


def merge_ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges as maximal disjoint ones (touching ones join)."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > hi[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(lo) - 1)
    return lo[new], hi[last]


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def first_of_runs(*columns: np.ndarray) -> np.ndarray:
    """Of equal-length sorted columns: True where a row differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    if len(new) > 1:
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def merge_by_row(ids, tids, lo, hi):
    """Join touching start ranges [lo, hi] of one row; several copies of a row count as one."""
    if not len(ids):
        return ids, tids, lo.astype(np.int64), hi.astype(np.int64)
    order = np.lexsort((lo, tids, ids))
    ids, tids, lo, hi = ids[order], tids[order], lo[order].astype(np.int64), hi[order].astype(np.int64)
    new = first_of_runs(ids, tids)
    rank, span = np.cumsum(new) - 1, int(hi.max()) + 3
    a, b = merge_ranges(rank * span + lo, rank * span + hi + 1)
    at = np.flatnonzero(new)[a // span]
    return ids[at], tids[at], a % span, b - a // span * span - 1

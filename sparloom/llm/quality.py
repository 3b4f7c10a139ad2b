"""Quality classifier: a factorisation machine over words, structure and metadata.

Features of a document: every word (lower-cased, hashed into buckets, weight
1/sqrt(words)), structure statistics of the text, and metadata (the stored
character count against the counted one).  Labels, language, source and id are
never inputs.  The score is the logistic of

    b + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i (v_if x_i)^2]

so all pairwise interactions cost time linear in the words (sum of squares
identity), for a batch of documents as segment sums.

The model is fitted on the driver from at most ``SAMPLE`` labelled rows, chosen
by a hash of the id among rows whose crc32(id) mod 5 is not 0; their whole texts
count, as bucket numbers.  Model and sample are bounded by parameters; the
model (a few hundred kB) is broadcast.

Defined cases: null and empty texts are scored by their (zero) statistics; with
no usable labels every score is 0.5; repeated label rows weigh repeatedly, and
rows with a null label or id aren't learnt from; a null id is not held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .substring_dedup import WORD

SAMPLE, BUCKETS, RANK = 4000, 1 << 13, 8
THRESHOLD = 0.3
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
NEWLINE = np.ones(256, bool)
NEWLINE[0x0A] = False


def _class(chars: bytes) -> np.ndarray:
    x = np.zeros(256, np.int64)
    x[list(chars)] = 1
    return x


#: Byte classes whose shares are structure statistics.
CLASSES = np.stack([
    _class(bytes(range(0x41, 0x5B))), _class(bytes(range(0x61, 0x7B))), _class(b"0123456789"), _class(b"!?"), _class(b".,;:"),
    _class(b"|\\/_~^=<>{}[]"), _class(b"#$%&*@+"), _class(b"\n"), _class(bytes(range(0x80, 0x100))), _class(b"\"'()-"),
])
N_STATS = len(CLASSES) + 8


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the segments first[i]:first[i+1], empty ones 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _distinct(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the count of the commonest one, per row."""
    _, at, many = np.unique(c.mix(h + row.astype(np.uint64) * c.U(0x9E3779B97F4A7C15)), return_index=True, return_counts=True)
    most = np.zeros(n)
    np.maximum.at(most, row[at], many)
    return np.bincount(row[at], minlength=n).astype(float), most


def features(data: np.ndarray, off: np.ndarray, stored: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each word, first word of each row, statistics per row)."""
    n = len(off) - 1
    low = LOWER[data]
    starts, ends, first = c.words_of(low, off, WORD)
    prefix = c.Prefix(c.LUT_A[low])
    h = prefix.hash(starts, ends)
    row = c.rows_of(first)
    words = np.diff(first).astype(float)
    size = np.diff(off).astype(float)
    some, some_words = np.maximum(size, 1), np.maximum(words, 1)
    # a byte histogram per row, then shares of its classes
    wide = np.repeat(np.arange(n), np.diff(off)) * 256 + data
    histogram = np.bincount(wide, minlength=256 * n).reshape(n, 256)
    shares = histogram @ CLASSES.T / some[:, None]
    distinct, most = _distinct(h, row, n)
    lo, hi, line_first = c.words_of(data, off, NEWLINE)
    lines = np.diff(line_first).astype(float)
    d_lines, most_lines = _distinct(prefix.hash(lo, hi), c.rows_of(line_first), n)
    chars = size - histogram[:, 0x80:0xC0].sum(axis=1)
    stats = np.column_stack([
        np.sqrt(shares), np.log1p(words), (size - histogram[:, [9, 10, 11, 12, 13, 32]].sum(axis=1)) / some_words,
        distinct / some_words, most / some_words, d_lines / np.maximum(lines, 1), most_lines / np.maximum(lines, 1),
        words / np.maximum(lines, 1) / 100, np.log1p(np.abs(np.nan_to_num(stored, nan=0.0) - chars)),
    ])
    return (h & c.U(BUCKETS - 1)).astype(np.int64), first, stats


@dataclass
class Machine:
    """Weights of buckets, then of statistics."""

    bias: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def inputs(self, first, stats):
        scale = 1 / np.sqrt(np.maximum(np.diff(first), 1))
        return scale, np.clip((stats - self.mean) / self.spread, -4, 4)

    def margin(self, bucket, first, stats):
        scale, z = self.inputs(first, stats)
        wb, vb, ws, vs = self.w[:BUCKETS], self.v[:BUCKETS], self.w[BUCKETS:], self.v[BUCKETS:]
        linear = _sums(wb[bucket], first) * scale + z @ ws
        one = _sums(vb[bucket], first) * scale[:, None] + z @ vs
        two = _sums((vb**2).sum(axis=1)[bucket], first) * scale**2 + z**2 @ (vs**2).sum(axis=1)
        return self.bias + linear + 0.5 * ((one**2).sum(axis=1) - two), one

    def score(self, bucket, first, stats):
        return 1 / (1 + np.exp(-np.clip(self.margin(bucket, first, stats)[0], -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 8, batch: int = 64, rate: float = 0.1, decay: float = 1e-4) -> Machine:
    """Adagrad on the logistic loss; rows are (buckets, statistics, label)."""
    rng = np.random.default_rng(5)
    v = rng.normal(0, 0.02, (BUCKETS + N_STATS, RANK))
    if not rows:
        return Machine(0.0, np.zeros(BUCKETS + N_STATS), v * 0, np.zeros(N_STATS), np.ones(N_STATS))
    stats = np.stack([r[1] for r in rows])
    label = np.array([r[2] for r in rows], float)
    m = Machine(0.0, np.zeros(BUCKETS + N_STATS), v, stats.mean(axis=0), stats.std(axis=0) + 1e-3)
    gw, gv, gb = np.full(len(m.w), 1e-2), np.full(m.v.shape, 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), batch):
            pick = order[i : i + batch]
            bucket = np.concatenate([rows[k][0] for k in pick]).astype(np.int64)
            first = np.append(0, np.cumsum([len(rows[k][0]) for k in pick]))
            margin, one = m.margin(bucket, first, stats[pick])
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[pick]) / len(pick)
            scale, z = m.inputs(first, stats[pick])
            row = c.rows_of(first)
            ex = (error * scale)[row]
            dw = np.append(np.bincount(bucket, ex, BUCKETS), error @ z) + decay * m.w
            square = np.append(np.bincount(bucket, ex * scale[row], BUCKETS), error @ z**2)
            cross = np.vstack([np.stack([np.bincount(bucket, ex * one[row, f], BUCKETS) for f in range(RANK)], axis=1), (z * error[:, None]).T @ one])
            dv = cross - m.v * square[:, None] + decay * m.v
            gw += dw**2
            gv += dv**2
            gb += error.sum() ** 2
            m.w -= rate * dw / np.sqrt(gw)
            m.v -= 0.3 * rate * dv / np.sqrt(gv)
            m.bias -= rate * error.sum() / np.sqrt(gb)
    return m


def _slim(docs: DataFrame, id_col: str, text_col: str, chars_col: str) -> DataFrame:
    stored = F.col(chars_col).cast("double") if chars_col in docs.columns else F.lit(None).cast("double")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"), stored.alias("stored"))


def _read(batch):
    data, off = c.text_buffers(batch.column(1))
    stored = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
    for i, j, part, poff in c.chunks(data, off):
        yield i, j, *features(part, poff, stored[i:j])


def _to_learn(batches):
    """(label, buckets, statistics) of the sampled rows."""
    for batch in batches:
        for i, j, bucket, first, stats in _read(batch):
            offsets = pa.array(first.astype(np.int32))
            wide = pa.array(np.arange(j - i + 1, dtype=np.int32) * N_STATS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), batch.column(3).slice(i, j - i), pa.ListArray.from_arrays(offsets, pa.array(bucket.astype(np.int16))), pa.ListArray.from_arrays(wide, pa.array(stats.ravel()))],
                names=["id", "label", "buckets", "stats"],
            )


def held_out(id_column) -> F.col:
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", chars_col: str = "n_chars", sample: int = SAMPLE) -> Machine:
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    chosen = usable.select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64(F.col("id").cast("string")), "id", "label").limit(sample)
    rows = _slim(docs, id_col, text_col, chars_col).join(F.broadcast(chosen), "id")  # at most ``sample`` rows are broadcast
    # rows that share a sampled id count once (least hash of text), so at most ``sample`` texts are learned from
    rows = rows.groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("body").alias("h"), "body", "stored")).alias("x")).select("id", "x.body", "x.stored", "label")
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(_to_learn, f"id {kind}, label int, buckets array<smallint>, stats array<double>").toPandas()
    found = found.assign(size=found["buckets"].map(len)).sort_values(["id", "size", "label"])
    return fit([(np.asarray(b), np.asarray(s, float), y) for b, s, y in zip(found["buckets"], found["stats"], found["label"])])


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """(id, score) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(machine)
    slim = _slim(docs, id_col, text_col, chars_col)

    def run(batches):
        for batch in batches:
            made = [model.value.score(bucket, first, stats) for _, _, bucket, first, stats in _read(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(made) if made else np.zeros(0))], names=["id", "score"])

    return slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, score double")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (c.read_table(spark, sf_dir, x) for x in ("documents", "labels"))
    scored = score(docs, train(docs, labels))
    return scored.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    machine = train(docs, c.read_table(spark, sf_dir, "labels"))
    model = spark.sparkContext.broadcast(machine)
    body, stored = c.fresh(docs.columns, "_body"), c.fresh(docs.columns, "_stored")
    wide = docs.withColumn(body, F.col("text").cast("string")).withColumn(stored, F.col("n_chars").cast("double"))
    n = len(docs.columns)

    def keep(batches):
        for batch in batches:
            view = pa.RecordBatch.from_arrays([batch.column(0), batch.column(n), batch.column(n + 1)], names=["id", "body", "stored"])
            made = [model.value.score(bucket, first, stats) for _, _, bucket, first, stats in _read(view)]
            ok = np.concatenate(made) >= THRESHOLD if made else np.zeros(0, bool)
            kept = batch.filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays(kept.columns[:n], names=kept.schema.names[:n])

    return wide.mapInArrow(keep, docs.schema)

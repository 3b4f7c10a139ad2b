"""Approximate nearest neighbours with a hash-prefix forest.

Each tree gives a vector a long string of symbols: a symbol names the axis, and
its sign, that the vector (less a centre) is nearest to after a random rotation.
The first symbol is taken about the mean of a bounded sample (``SAMPLE`` rows chosen
by a hash of the id; all rows are indexed), each further one about a sampled vector of its
own, so a dense cluster is parted too.  A tree is the sorted array of its strings.

A query descends in every tree to the longest prefix it shares and ascends bit by bit,
all trees together, until the trees hold ``ENOUGH`` candidates in all.  Where whole
first symbols hold fewer, it goes on at the root to the sibling symbols of all trees in
order of how much further they are, until there are enough, or until a vector as
near as the k-th found would hardly (``SIGMAS`` deviations) lie there.  Candidates
are ranked by their exact distance.

Distribution: an array is cut by string prefixes, of the first symbol at least and as many
bits as give cells of about ``BLOCK`` vectors, up to two symbols; a fuller cell is dealt into
blocks by a hash of the id.  The driver holds one count for each cell (at most
``TREES`` << 14).  Levels are counted on strings alone; vectors move twice.  Equal vectors are
one entry with its k + 1 smallest ids (more of them can never be listed), and one query.

Vectors that are null, all zero or hold null, NaN or infinite components take no
part, nor do those of another length than the sample's commonest; an empty table
gives no rows; rows with one id and vector count once; ties go to smaller ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

TREES, AXES, SAMPLE, BLOCK, ENOUGH, SIGMAS = 8, 64, 4096, 8192, 20480, 2.0
FOUND = "query long, vec_id long, score double"


class Trees:
    """Rotations and centres of every symbol of every tree."""

    def __init__(self, sample: np.ndarray, trees: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        size = sample.shape[1]
        self.trees, self.size, axes = trees, size, min(size, AXES)
        self.bits = max(1, (2 * axes - 1).bit_length())
        self.symbols = max(2, 42 // self.bits)
        self.levels = self.bits * self.symbols
        self.turns = [np.linalg.qr(rng.normal(size=(size, axes)))[0].astype(np.float32) for _ in range(trees * self.symbols)]
        self.centres = sample[rng.integers(0, len(sample), trees * self.symbols)]
        self.centres[:: self.symbols] = sample.mean(axis=0)

    def sides(self, vectors: np.ndarray, tree: int, symbol: int = 0) -> np.ndarray:
        """How far each vector reaches along each axis and its opposite."""
        k = tree * self.symbols + symbol
        along = (vectors - self.centres[k]) @ self.turns[k]
        return np.concatenate([along, -along], axis=1)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, trees) strings, the first symbol highest."""
        made = np.zeros((len(vectors), self.trees), np.int64)
        for tree in range(self.trees):
            for symbol in range(self.symbols):
                made[:, tree] = made[:, tree] << self.bits | self.sides(vectors, tree, symbol).argmax(axis=1)
        return made


class Cells:
    """Counts of the cells of all trees, and the parts their blocks are."""

    def __init__(self, counts: np.ndarray, depth: int):
        self.depth, self.counts = depth, counts
        self.blocks = np.maximum(1, -(-counts // BLOCK))
        self.first = np.append(0, np.cumsum(self.blocks))
        self.below = np.append(0, np.cumsum(counts))

    def span(self, tree: int, prefix: int, bits: int) -> tuple[int, int]:
        """The cells under a prefix of ``bits`` (at most depth)."""
        a = (tree << self.depth) + (prefix << (self.depth - bits))
        return a, a + (1 << (self.depth - bits))

    def total(self, span: tuple[int, int]) -> int:
        return int(self.below[span[1]] - self.below[span[0]])

    def parts(self, span: tuple[int, int]) -> range:
        return range(int(self.first[span[0]]), int(self.first[span[1]]))


def _matrix(column, n: int) -> np.ndarray:
    values = column.values.slice(column.offsets[0].as_py(), column.offsets[-1].as_py() - column.offsets[0].as_py()) if n else column.values
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _long_lists(column, n: int) -> np.ndarray:
    start, end = column.offsets[0].as_py(), column.offsets[-1].as_py()
    return column.values.slice(start, end - start).to_numpy(zero_copy_only=False).reshape(n, -1)


def _strings(trees):
    """(query, string of each tree) of entries."""

    def run(batches):
        for batch in batches:
            made = trees.value.strings(_matrix(batch.column("vector"), len(batch)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * trees.value.trees), pa.array(made.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "strings"])

    return run


def _entries(trees, cells, with_vectors: bool):
    """Every entry once a tree, in its part."""

    def run(batches):
        t, p = trees.value, cells.value
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            strings = _long_lists(batch.column("strings"), n)
            cell = (np.arange(t.trees) << p.depth) + (strings >> (t.levels - p.depth))
            salt = c.mix(batch.column("id").to_numpy().view(np.uint64)) % p.blocks[cell].T.astype(np.uint64)
            part = (p.first[cell] + salt.T.astype(np.int64)).ravel()
            columns, names = [pa.array(part), pa.nulls(n * t.trees, pa.int64()), pa.array(strings.ravel())], ["part", "query", "string"]
            if with_vectors:
                take = pa.array(np.repeat(np.arange(n), t.trees))
                columns += [pa.nulls(n * t.trees, pa.int32()), batch.column("ids").take(take), batch.column("vector").take(take)]
                names += ["bits", "ids", "vector"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _asked(trees, cells):
    """Every query once for each block of its own cells, without its vector."""

    def run(batches):
        t, p = trees.value, cells.value
        for batch in batches:
            out = ([], [], [])
            for q, strings in zip(batch.column("id").to_pylist(), batch.column("strings").to_pylist()):
                for tree, s in enumerate(strings):
                    for part in p.parts(p.span(tree, s >> (t.levels - p.depth), p.depth)):
                        for x, y in zip(out, (part, q, s)):
                            x.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["part", "query", "string"])

    return run


def _own(trees, cells, enough: int):
    """Queries with the bits they may keep in common (null if their cells are too few): a row for each part to look at."""

    def run(batches):
        t, p = trees.value, cells.value
        for batch in batches:
            out, rows = ([], [], [], []), []
            for row, (q, strings, bits) in enumerate(zip(batch.column("id").to_pylist(), batch.column("strings").to_pylist(), batch.column("bits").to_pylist())):
                depth = p.depth
                if bits is None:  # ascend on counts of cells alone
                    bits = depth
                    while bits > t.bits and sum(p.total(p.span(k, s >> (t.levels - bits), bits)) for k, s in enumerate(strings)) < enough:
                        bits -= 1
                for tree, s in enumerate(strings):
                    level = min(bits, depth)
                    for part in p.parts(p.span(tree, s >> (t.levels - level), level)):
                        for x, y in zip(out, (part, q, s, bits)):
                            x.append(y)
                        rows.append(row)
            take = pa.array(rows, pa.int64())
            columns = [*(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.int32()), batch.column("ids").take(take), batch.column("vector").take(take)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "query", "string", "bits", "ids", "vector"])

    return run


def _siblings(trees, cells, enough: int):
    """Queries whose whole first symbols were not enough: a row for each part of the next symbols of all trees.

    ``reach`` is the distance of the k-th found (null if fewer were found).
    """

    def run(batches):
        t, p = trees.value, cells.value
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            vectors = _matrix(batch.column("vector"), n)
            further = []
            for tree in range(t.trees):
                sides = t.sides(vectors, tree)
                further.append(sides.max(axis=1, keepdims=True) - sides)
            further = np.concatenate(further, axis=1)
            each = further.shape[1] // t.trees
            own = [_first.argmin(axis=1) for _first in np.split(further, t.trees, axis=1)]
            out, rows = ([], []), []
            for row, (q, reach) in enumerate(zip(batch.column("id").to_pylist(), batch.column("reach").to_pylist())):
                limit = np.inf if reach is None else SIGMAS * reach * np.sqrt(2 / t.size)
                home = {(tree, int(own[tree][row])) for tree in range(t.trees)}
                held = sum(p.total(p.span(*h, t.bits)) for h in home)
                for k in np.argsort(further[row], kind="stable").tolist():
                    if held >= enough or further[row, k] > limit:
                        break
                    node = divmod(k, each)
                    if node in home:
                        continue
                    span = p.span(*node, t.bits)
                    if not (many := p.total(span)):
                        continue
                    held += many
                    for part in p.parts(span):
                        out[0].append(part)
                        out[1].append(q)
                        rows.append(row)
            take = pa.array(rows, pa.int64())
            zero = pa.array(np.zeros(len(rows), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), zero, zero.cast(pa.int32()), batch.column("ids").take(take), batch.column("vector").take(take)], names=["part", "query", "string", "bits", "ids", "vector"])

    return run


def _by_part(work):
    """Rows sorted by (part, query, string), entries first: ``work(entries, queries)`` for every part that has both."""

    def run(batches):
        held = None

        def done(table):
            parts = table.column("part").to_numpy()
            cuts = np.append(np.flatnonzero(c.first_of_runs(parts)), len(parts))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                rows = table.slice(a, b - a)
                n = rows.column("query").null_count
                if n not in (0, b - a):
                    yield from work(rows.slice(0, n), rows.slice(n))

        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            parts = held.column("part").to_numpy()
            if not len(parts):
                continue
            cut = int(np.searchsorted(parts, parts[-1]))
            yield from done(held.slice(0, cut))
            held = held.slice(cut)
        if held is not None:
            yield from done(held)

    return run


def _levels(levels: int, least: int):
    """How many entries of a part share each number of bits with each query."""

    def work(entries, queries):
        strings, asked = entries.column("string").to_numpy(), queries.column("string").to_numpy()
        for bits in range(levels, least - 1, -1):
            first = asked >> (levels - bits) << (levels - bits)
            many = np.searchsorted(strings, first + (1 << (levels - bits))) - np.searchsorted(strings, first)
            have = np.flatnonzero(many)
            yield pa.RecordBatch.from_arrays([queries.column("query").take(pa.array(have)).combine_chunks(), pa.array(np.full(len(have), bits, np.int32)), pa.array(many[have].astype(np.int64))], names=["query", "bits", "many"])

    return work


def _nearest(k: int, levels: int):
    """The best k entries of a part for each of its queries, among those that share the bits asked for."""

    def work(entries, queries):
        strings, ids = entries.column("string").to_numpy(), entries.column("ids").to_pylist()
        vectors = np.vstack([_matrix(x, len(x)) for x in entries.column("vector").chunks])
        asked = np.vstack([_matrix(x, len(x)) for x in queries.column("vector").chunks])
        out = []
        for q, s, bits, v in zip(queries.column("query").to_pylist(), queries.column("string").to_pylist(), queries.column("bits").to_pylist(), asked):
            first = s >> (levels - bits) << (levels - bits)
            lo, hi = (0, len(strings)) if not bits else np.searchsorted(strings, [first, first + (1 << (levels - bits))]).tolist()
            if lo == hi:
                continue
            gap = vectors[lo:hi] - v
            far = np.sqrt((gap * gap).sum(axis=1))
            last = np.partition(far, k - 1)[k - 1] if k < len(far) else np.inf  # all as near as the k-th: ties are settled by id
            found = sorted((float(far[i]), x) for i in np.flatnonzero(far <= last).tolist() for x in ids[lo + i])
            out += [(q, x, d) for d, x in found[:k]]
        if out:
            q, v, d = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(d, pa.float64())], names=["query", "vec_id", "score"])

    return work


def nearest(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES, enough: int = ENOUGH) -> DataFrame:
    """(query_id, rank, vec_id, score): ``is_query`` is a condition on the column 'id'."""
    spark = vectors.sparkSession
    ws = c.Workspace(spark, "nearest")
    # single precision travels as such; all reckoning is in double precision
    kind_of = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind_of).alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).where(fine & F.exists("vector", lambda x: x != 0.0))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()["vector"]
    sizes = sample.map(len)
    if not len(sizes):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = int(sizes.mode()[0])
    forest = Trees(np.stack(sample[sizes == size].to_list()), trees)
    shared = spark.sparkContext.broadcast(forest)
    rows = rows.where(F.size("vector") == size).withColumn("asks", is_query)
    by_vector = Window.partitionBy("vector").orderBy("id")
    entries = rows.groupBy("vector", "id").agg(F.first("asks").alias("asks"))
    asking = entries.where("asks").select("vector", "id")
    least = entries.withColumn("number", F.row_number().over(by_vector)).where(F.col("number") <= k + 1).groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    asked = asking.select("vector").distinct().withColumn("asks", F.lit(True))
    least = least.join(asked, "vector", "left").select(F.col("ids")[0].alias("id"), "ids", "vector", F.coalesce("asks", F.lit(False)).alias("asks"))
    index = ws.save(least.mapInArrow(_strings(shared), f"id long, ids array<long>, vector {kind_of}, asks boolean, strings array<long>"), "index")

    total = index.count()
    depth = int(min(max(forest.bits, np.ceil(np.log2(max(total / BLOCK, 1)))), 2 * forest.bits))
    prefix = F.posexplode(F.transform("strings", lambda s: F.shiftright(s, forest.levels - depth)))
    counts = np.zeros(trees << depth, np.int64)
    for r in index.select(prefix.alias("tree", "prefix")).groupBy("tree", "prefix").count().toLocalIterator():  # at most trees << depth rows
        counts[(r.tree << depth) + r.prefix] = r["count"]
    cells = spark.sparkContext.broadcast(Cells(counts, depth))
    queries = index.where("asks").select("id", "ids", "vector", "strings")

    both = index.mapInArrow(_entries(shared, cells, False), "part long, query long, string long").unionByName(queries.mapInArrow(_asked(shared, cells), "part long, query long, string long"))
    dealt = lambda df: df.repartition("part").sortWithinPartitions("part", F.asc_nulls_first("query"), "string")
    levels = dealt(both).mapInArrow(_by_part(_levels(forest.levels, depth)), "query long, bits int, many long")
    deep = levels.groupBy("query", "bits").agg(F.sum("many").alias("many")).where(F.col("many") >= enough).groupBy("query").agg(F.max("bits").alias("bits"))
    queries = ws.save(queries.join(deep.withColumnRenamed("query", "id"), "id", "left"), "queries")

    kind = f"part long, query long, string long, bits int, ids array<long>, vector {kind_of}"
    whole = index.mapInArrow(_entries(shared, cells, True), kind)
    search = lambda looks: dealt(whole.unionByName(looks)).mapInArrow(_by_part(_nearest(k + 1, forest.levels)), FOUND).distinct()
    by_query = Window.partitionBy("query").orderBy("score", "vec_id")
    best = lambda found: found.withColumn("place", F.row_number().over(by_query)).where(F.col("place") <= k + 1)
    first = ws.save(best(search(queries.mapInArrow(_own(shared, cells, enough), kind))), "own")
    reach = first.where(F.col("place") == k + 1).select(F.col("query").alias("id"), F.col("score").alias("reach"))
    rest = queries.where("bits is null").join(reach, "id", "left")
    more = search(rest.mapInArrow(_siblings(shared, cells, enough), kind))
    found = best(first.select("query", "vec_id", "score").unionByName(more).distinct())
    lists = ws.save(found.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("near")).join(queries.select(F.col("id").alias("query"), "vector"), "query").select("vector", "near"), "lists")
    ws.drop("index", "queries", "own")
    own = asking.join(lists, "vector").select(F.col("id").alias("query_id"), F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("id")), 1, k).alias("near"))
    return own.select("query_id", F.posexplode("near").alias("at", "x")).select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(c.read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)

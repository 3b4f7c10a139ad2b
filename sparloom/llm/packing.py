"""Best-fit packing by linear grouping.

Lengths are at most the sequence length (2048), so their histogram is bounded
and all packing is decided on it; documents are never gathered.

1. Pieces.  Documents are tokenized once; each piece knows its length and its
   place among equal lengths of its task.  Counts per (length, task) are summed
   to give every piece a rank among all pieces of its length.
2. Grouping.  Large lengths (over an eighth, a quarter, a third or half of a
   sequence, whichever needs the fewest), in descending order, fall into groups of equal cardinality, each rounded up to its longest.
3. Configurations.  The few rounded sizes are packed by the linear programme
   over configurations (column generation: a revised simplex whose columns come
   from a knapsack), rounded down.
4. Substitution.  Actual lengths take the places of their group; what rounding
   left over, then the small pieces, go best-fit into the space that remains.

The plan says for a range of ranks of one length which sequences and offsets it
fills: a few thousand rows at most, whatever the input's size, so it is
broadcast.

Defined cases: null or empty texts are the end token alone; a text over the
sequence length is cut into full pieces and a rest; repeated rows are packed
again; null ids pass through.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

LENGTH = 2048
#: Words of which lower-casing and splitting need no Unicode tables.
_SIMPLE_WORD = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_SIMPLE_TEXT = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


class WordTokenizer:
    """The tokenizer's ids, remembered part by part.

    Its pre-tokenizer splits a text into runs of letters, digits and runs of
    other signs, never across white space, and its model works within these
    parts only, so a text's ids are those of its parts, one after the other.
    Parts not seen before go to the tokenizer together, joined by spaces: every
    part's last id is one that ends words.  Words beyond plain Latin letters and
    signs, or that may hold the tokenizer's own control strings, are encoded
    whole.  The memory of parts is bounded.
    """

    def __init__(self, path: str, most: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.seen: dict[str, bytes] = {}
        self.most = most

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _parts(self, text: str) -> list[str]:
        """Keys of ``seen``; a whole word's key begins with a zero character."""
        if _SIMPLE_TEXT.fullmatch(text) and "<|" not in text:
            return _PARTS.findall(text.lower())
        if _SEPARATORS.search(text):  # white space for Python, not for the pattern
            return ["\0" + text]
        found = []
        for word in text.split():
            if _SIMPLE_WORD.fullmatch(word) and "<|" not in word:
                found += _PARTS.findall(word.lower())
            else:
                found.append("\0" + word)
        return found

    def _learn(self, parts: list[str]) -> None:
        whole = [p for p in parts if p[0] == "\0"]
        parts = [p for p in parts if p[0] != "\0"]
        for p in whole:
            self.seen[p] = self._encode(p[1:]).tobytes()
        for k in range(0, len(parts), 512):
            some = parts[k : k + 512]
            ids = self._encode(" ".join(some))
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) == len(some):
                raw, at = ids.tobytes(), 0
                for part, end in zip(some, (4 * last).tolist()):
                    self.seen[part] = raw[at:end]
                    at = end
            else:
                self.seen |= {part: self._encode(part).tobytes() for part in some}

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.seen) > self.most:
            self.seen.clear()
        split = [self._parts(t) for t in texts]
        new = set().union(*(set(parts).difference(self.seen) for parts in split))
        if new:
            self._learn(sorted(new))
        get = self.seen.__getitem__
        made = [b"".join(map(get, parts)) for parts in split]
        for key in [k for k in new if len(k) > 100]:
            del self.seen[key]
        return made


def _pieces(path: str, length: int):
    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        tokenizer, seen = WordTokenizer(path), np.zeros(length + 1, np.int64)
        end = b"\0\0\0\0"
        for batch in batches:
            row, piece, start, size, crc = [], [], [], [], []
            for first in range(0, len(batch), 256):
                texts = [x or "" for x in batch.column(1).slice(first, 256).to_pylist()]
                for r, ids in enumerate(tokenizer.ids(texts), first):
                    ids += end
                    for k in range(0, len(ids), 4 * length):
                        part = ids[k : k + 4 * length]
                        row.append(r)
                        piece.append(k // (4 * length))
                        start.append(k // 4)
                        size.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            size = np.array(size, np.int64)
            order = np.argsort(size, kind="stable")
            ranks = np.arange(len(size)) - np.searchsorted(size[order], size[order]) + seen[size[order]]
            place = np.empty(len(size), np.int64)
            place[order] = ranks
            seen += np.bincount(size, minlength=length + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size), pa.array(crc, pa.int64()), pa.array(np.full(len(size), task, np.int32)), pa.array(place)],
                names=["id", "piece", "start", "length", "ids_crc32", "task", "place"],
            )

    return run


# --------------------------------------------------------------------------
# the plan, on the histogram


def _knapsack(sizes: list[int], worth: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable configuration of the given sizes."""
    best = np.zeros(room + 1)
    pick = np.full(room + 1, -1)
    for i, s in enumerate(sizes):
        if worth[i] <= 1e-12:
            continue
        for _ in range(room // s):
            with_i = best[: room + 1 - s] + worth[i]
            better = with_i > best[s:] + 1e-12
            if not better.any():
                break
            best[s:][better] = with_i[better]
            pick[s:][better] = i
    # the picks may be of different rounds, so the configuration is read back by value
    config, at = np.zeros(len(sizes), np.int64), room
    while at > 0 and best[at] > 1e-12:
        i = pick[at]
        if i >= 0 and abs(best[at] - best[at - sizes[i]] - worth[i]) < 1e-9:
            config[i] += 1
            at -= sizes[i]
        else:
            at -= 1
    return float(config @ worth), config


def configurations(sizes: list[int], need: np.ndarray, room: int, rounds: int = 2000) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often each is used (rounded down) in the linear programme."""
    m = len(sizes)
    basis = np.diag([float(room // s) for s in sizes])
    configs = [basis[:, i].astype(np.int64) for i in range(m)]
    inverse = np.linalg.inv(basis)
    x = inverse @ need
    for number in range(rounds):
        prices = inverse.sum(axis=0)
        value, config = _knapsack(sizes, prices, room)
        if value <= 1 + 1e-7:
            break
        step = inverse @ config
        up = step > 1e-10
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = x[up] / step[up]
        out = int(np.argmin(ratio))
        theta = ratio[out]
        x -= theta * step
        x[out] = theta
        configs[out] = config
        inverse[out] /= step[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(step[others], inverse[out])
        if number % 100 == 99:
            inverse = np.linalg.inv(np.array(configs, float).T)
            x = np.maximum(inverse @ need, 0)
    return [(cfg, int(np.floor(v + 1e-7))) for cfg, v in zip(configs, x) if v >= 1 - 1e-7]


class Plan:
    """Classes of equal sequences: first id, how many, what is free, [(length, per sequence, offset)]."""

    def __init__(self, counts: np.ndarray, length: int = LENGTH, groups: int = 48, large: int = 8):
        self.length, self.left = length, counts.astype(np.int64).copy()
        self.classes: list[list] = []  # [first, how many, used, items]
        self.next = 0
        self.by_room: dict[int, list[int]] = {}
        self._large(groups, length // large)
        for size in range(length, 0, -1):
            self._best_fit(size)

    def _open(self, many: int, items: list[tuple[int, int]]) -> None:
        used, placed = 0, []
        for size, per in items:
            placed.append((size, per, used))
            used += size * per
        self._file([self.next, many, used, placed])
        self.next += many

    def _file(self, cls: list) -> None:
        self.classes.append(cls)
        self.by_room.setdefault(self.length - cls[2], []).append(len(self.classes) - 1)

    def _large(self, groups: int, floor: int) -> None:
        left = self.left
        sizes = [s for s in range(self.length - 1, floor, -1) if left[s]]
        total = int(sum(left[s] for s in sizes))
        if not total:
            return
        share, queues, row = -(-total // groups), [], 0
        if len(sizes) <= groups:  # few sizes as they are: nothing to round
            queues, sizes_left = [[[s, int(left[s])]] for s in sizes], []
        else:
            sizes_left = sizes
        for s in sizes_left:  # runs of [length, how many], in groups of equal cardinality
            n = int(left[s])
            while n:
                if row % share == 0:
                    queues.append([])
                take = min(n, share - row % share)
                queues[-1].append([s, take])
                row += take
                n -= take
        merged: dict[int, list] = {}
        for q in queues:  # groups that round to one size are one
            merged.setdefault(q[0][0], []).extend(q)
        rounded = list(merged)
        need = np.array([sum(n for _, n in merged[s]) for s in rounded], float)
        for config, many in configurations(rounded, need, self.length):
            slots = [i for i in np.flatnonzero(config) for _ in range(config[i])]
            while many:
                heads, cursor = [], {}
                for i in slots:  # each slot takes from its group's queue, run after run
                    q, (at, used) = merged[rounded[i]], cursor.get(i, (0, 0))
                    if at < len(q) and used >= q[at][1]:
                        at, used = at + 1, 0
                    if at >= len(q):
                        continue
                    heads.append((i, at))
                    cursor[i] = (at, used + 1)
                if not heads:
                    return
                uses: dict[tuple[int, int], int] = {}
                for h in heads:
                    uses[h] = uses.get(h, 0) + 1
                times = min([many, *(merged[rounded[i]][at][1] // n for (i, at), n in uses.items())])
                items: dict[int, int] = {}
                for (i, at), n in uses.items():
                    run = merged[rounded[i]][at]
                    run[1] -= n * times
                    left[run[0]] -= n * times
                    items[run[0]] = items.get(run[0], 0) + n
                for i in {i for i, _ in uses}:
                    merged[rounded[i]] = [r for r in merged[rounded[i]] if r[1]]
                self._open(times, sorted(items.items(), reverse=True))
                many -= times

    def _best_fit(self, size: int) -> None:
        """All left of one length, each into the fullest sequence that holds it."""
        while self.left[size]:
            room = min((r for r in self.by_room if r >= size), default=None)
            n = int(self.left[size])
            if room is None:
                per = min(self.length // size, n)
                self._open(n // per, [(size, per)])
                self.left[size] -= per * (n // per)
                continue
            at = self.by_room[room].pop()
            if not self.by_room[room]:
                del self.by_room[room]
            first, many, used, items = self.classes[at]
            per = min(room // size, n)
            take = min(many, n // per)
            self.classes[at] = [first, take, used + per * size, [*items, (size, per, used)]]
            self.by_room.setdefault(room - per * size, []).append(at)
            if take < many:
                self._file([first + take, many - take, used, items])
            self.left[size] -= take * per

    def runs(self) -> np.ndarray:
        """Rows (length, first rank, first sequence, offset, per sequence), sorted."""
        taken, rows = {}, []
        for first, many, _, items in self.classes:
            for size, per, offset in items:
                rank = taken.get(size, 0)
                rows.append((size, rank, first, offset, per))
                taken[size] = rank + many * per
        return np.array(sorted(rows), np.int64).reshape(-1, 5)


def best_plan(counts: np.ndarray, length: int = LENGTH) -> Plan:
    """The plan of fewest sequences among the shares of a sequence over which a length is large."""
    return min((Plan(counts, length, large=share) for share in (8, 4, 3, 2)), key=lambda plan: plan.next)


def _assign(runs):
    def run(batches):
        size, rank0, first, offset, per = runs.value.T
        keys = size.astype(np.int64) * (1 << 46) + rank0
        for batch in batches:
            n, rank = (batch.column(k).to_numpy() for k in ("length", "rank"))
            at = np.searchsorted(keys, n * (1 << 46) + rank, "right") - 1
            k = rank - rank0[at]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(first[at] + k // per[at]), pa.array(offset[at] + n * (k % per[at]))], names=[*names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    spark = docs.sparkSession
    ws = c.Workspace(spark, "packing")
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    kind = slim.schema["id"].dataType.simpleString()
    pieces = ws.save(slim.mapInArrow(_pieces(tokenizer_path, length), f"id {kind}, piece int, start long, length long, ids_crc32 long, task int, place long"), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = ws.save(counts.select("length", "task", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    histogram = np.zeros(length + 1, np.int64)
    for row in bases.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``length`` rows
        histogram[row.length] = row.n
    runs = spark.sparkContext.broadcast(best_plan(histogram, length).runs())
    # the bases grow with tasks times lengths, so they are not to be broadcast
    ranked = pieces.join(bases.select("length", "task", "base").hint("merge"), ["length", "task"])
    ranked = ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("place")).alias("rank"))
    return ranked.mapInArrow(_assign(runs), f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(c.read_table(spark, sf_dir, "documents"), default_tokenizer()).withColumnRenamed("id", "doc_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places."""
    return pack(docs, default_tokenizer()).withColumnRenamed("id", "doc_id")

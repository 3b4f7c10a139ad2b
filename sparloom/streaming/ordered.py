"""Rows of one key in order of a column, whatever batches they come in.

What a worker can't hold waits in files of the task: sorted runs, merged as they
are read.  They have no name, so they end with the task.
"""

from __future__ import annotations

import gzip
import heapq
import os
import pickle
import random
import tempfile
from collections.abc import Iterator
from itertools import islice
from typing import IO, NamedTuple

import pandas as pd

# Bytes of rows held at once, and runs of one level (a run is read in as many blocks, so that merging them takes no more).
ROOM, RUNS = 32 << 20, 64


class Run(NamedTuple):
    level: int
    block: int  # rows of a block
    file: IO[bytes]


def _sorted(parts: list[pd.DataFrame], by: str) -> Iterator[tuple]:
    pdf = parts[0] if len(parts) == 1 else pd.concat(parts)
    if not pdf[by].is_monotonic_increasing:
        pdf = pdf.sort_values(by, kind="stable")
    return zip(*(pdf[c].tolist() for c in pdf.columns))


def _write(rows: Iterator[tuple], level: int, block: int) -> Run:
    folder = random.choice(os.environ.get("SPARK_LOCAL_DIRS", "").split(","))  # where the engine spills
    file = tempfile.TemporaryFile(dir=folder or None)
    with gzip.GzipFile(fileobj=file, mode="wb", compresslevel=1) as out:
        while held := list(islice(rows, block)):
            pickle.dump(held, out, -1)
        pickle.dump(None, out, -1)
    file.seek(0)
    return Run(level, block, file)


def _read(run: Run) -> Iterator[tuple]:
    with run.file, gzip.GzipFile(fileobj=run.file) as held:
        while (block := pickle.load(held)) is not None:  # a file cut short raises
            yield from block


def _merge(runs: list[Run], at: int) -> Iterator[tuple]:
    return heapq.merge(*map(_read, runs), key=lambda row: (True, 0) if row[at] is None or row[at] != row[at] else (False, row[at]))


def in_order(parts: Iterator[pd.DataFrame], by: str) -> Iterator[dict]:
    """Rows as dicts, nulls last; rows with equal values keep the order they came in."""
    held, size, runs, columns = [], 0, [], None
    for part in parts:
        if columns is None:
            columns = list(part.columns)
        if held:  # a lone part, as most keys have, is not weighed
            size += int(held[-1].memory_usage(index=False, deep=True).sum())
        if size > ROOM:
            runs.append(_write(_sorted(held, by), 0, max(sum(map(len, held)) // RUNS, 1)))
            held, size = [], 0
            while len(runs) >= RUNS and runs[-RUNS].level == runs[-1].level:
                last = runs[-RUNS:]
                runs[-RUNS:] = [_write(_merge(last, columns.index(by)), last[0].level + 1, min(r.block for r in last))]
        held.append(part)
    if runs:
        runs.append(_write(_sorted(held, by), 0, max(sum(map(len, held)) // RUNS, 1)))
        rows, held = _merge(runs, columns.index(by)), []
    else:
        rows = _sorted(held, by) if held else ()
    for row in rows:  # as dicts, rows take many times their size
        yield dict(zip(columns, row))

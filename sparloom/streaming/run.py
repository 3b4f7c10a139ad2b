"""Machines as streaming operators and as batch folds."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.schemas import flat, names
from .ordered import in_order

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Rows and characters that a key gives out at once.
SLICE, SLICE_CHARS = 10_000, 8 << 20


def _plain(row) -> dict:
    return {k: (None if v is None or isinstance(v, float) and pd.isna(v) else v.item() if hasattr(v, "item") else v) for k, v in row.items()}


class MachineProcessor(StatefulProcessor):
    """Keeps one machine per key; its state is one JSON value."""

    def __init__(self, machine):
        self.machine = machine

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("machine", flat("state string"))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        held = self.value.get()  # each call is a message to the engine, so it isn't asked first whether there is one
        machine = self.machine(json.loads(held[0]) if held is not None else None)
        out, chars = [], 0
        for row in in_order(rows, "seq"):
            for made in machine.step(_plain(row)):
                out.append(made)
                chars += sum(len(x) for x in made if isinstance(x, str))
            if len(out) >= SLICE or chars >= SLICE_CHARS:
                yield pd.DataFrame(out, columns=names(self.machine.schema))
                out, chars = [], 0
        yield pd.DataFrame(out, columns=names(self.machine.schema))
        self.value.update((json.dumps(machine.state()),))

    def close(self) -> None:
        pass


def stream(rows: DataFrame, machine, *keys: str) -> DataFrame:
    """The machine over a stream, one instance per key (rows of a key come in order of seq within a batch)."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return rows.groupBy(*keys).transformWithStateInPandas(statefulProcessor=MachineProcessor(machine), outputStructType=flat(machine.schema), outputMode="Append", timeMode="None")


def fold(rows: DataFrame, machine, *keys: str) -> DataFrame:
    """The same over a finished table: rows arrive sorted, so a worker holds one batch and one machine."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, of = None, None
        for pdf in batches:
            out = []
            for row in map(_plain, pdf.to_dict("records")):
                key = tuple(row[k] for k in keys)
                if made is None or key != of:
                    made, of = machine(None), key
                out += made.step(row)
            yield pd.DataFrame(out, columns=names(machine.schema))

    return rows.repartition(*keys).sortWithinPartitions(*keys, "seq").mapInPandas(run, machine.schema)


def run_available(rows: DataFrame, machine, *keys: str, sink: str, checkpoint: str) -> None:
    """Process what there is and append it to Parquet (exactly once, by the checkpoint)."""
    out = stream(rows, machine, *keys)
    query = out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def windowed(rows: DataFrame, ts: str, late: str, size: str, *keys: str) -> DataFrame:
    """Counts per event-time window with a watermark."""
    from pyspark.sql import functions as F

    return rows.withWatermark(ts, late).groupBy(F.window(ts, size), *keys).agg(F.count(F.lit(1)).alias("n"))

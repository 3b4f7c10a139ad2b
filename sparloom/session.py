"""Session defaults that suit both one machine and a cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(app: str = "sparloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; keywords use '__' for '.'."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# The engine's own bound of an Arrow batch, and ours: as Python objects a batch takes many times its bytes.
ENGINE_BATCH, BATCH_BYTES = 64 << 20, 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for Python workers, unless the deployment has set its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key).lower() in (str(ENGINE_BATCH), f"{ENGINE_BATCH}b"):
        spark.conf.set(key, str(BATCH_BYTES))

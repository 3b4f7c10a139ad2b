"""The folder that driver and executors share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; an own one is set only where there is none, in local mode."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = f"/tmp/checkpoints/sparloom-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")

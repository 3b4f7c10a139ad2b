"""File sources and sinks: corpus, ledger, history, transcripts, source trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CORPUS = "tool string, shape string, bytes long, sha string, captured_at long, server string, result_id string, raw string, _corrupt_record string"
LEDGER = (
    "ts long, version string, server string, tool string, decision string, diff_reason string, raw_chars long, out_chars long, raw_tokens long, "
    "out_tokens long, event string, path string, hit boolean, bytes long, tokens long, cadence string, attached boolean, _corrupt_record string"
)
HISTORY = "ts long, label string, n_payloads long, lossless_pass long, raw_tok long, compressed_tok long, saved_tok long, saved_pct double"


def _json(spark: SparkSession, paths, schema: str, whole: bool = False) -> DataFrame:
    """Lines (or whole files) parsed to the schema; what does not parse is in _corrupt_record."""
    lines = spark.read.option("wholetext", whole).text(paths).where("trim(value) <> ''").select("value", F.col("_metadata.file_name").alias("file"))
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return lines.select(parsed.alias("r"), "file").select("r.*", "file")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """One envelope per file; broken ones and those without tool or raw go; files with a leading '_' are no data."""
    rows = _json(spark, path, CORPUS, whole=True)
    return rows.where("_corrupt_record is null and raw is not null and tool is not null").drop("_corrupt_record").orderBy(F.coalesce("captured_at", F.lit(0)), "file")


def corrupt_files(spark: SparkSession, path: str) -> DataFrame:
    """How many files could not be read."""
    rows = _json(spark, path, CORPUS, whole=True)
    return rows.agg(F.count_if(F.col("_corrupt_record").isNotNull()).alias("corrupt"))


def write_corpus(envelopes: DataFrame, path: str) -> None:
    """First sightings by (tool, sha), partitioned by tool."""
    from ..operators.corpus import first_sightings

    first_sightings(envelopes).write.mode("append").partitionBy("tool").parquet(path)


def read_ledger(spark: SparkSession, *paths: str, since: int | None = None) -> DataFrame:
    """Rows of all generations; torn lines go; with ``since``, rows without a time go too."""
    rows = _json(spark, list(paths), LEDGER)
    rows = rows.where("_corrupt_record is null").drop("_corrupt_record", "file")
    return rows if since is None else rows.where(F.col("ts") >= since)


def append_ledger(rows: DataFrame, path: str) -> None:
    """Append by day, so retention drops whole days."""
    rows.withColumn("day", F.to_date(F.timestamp_seconds("ts"))).write.mode("append").partitionBy("day").json(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, HISTORY).where("ts is not null").drop("file")


def append_history(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def append_audit(rows: DataFrame, path: str) -> None:
    """Replay records: tool, id, tiers, changed, blocks [(raw, emitted)]."""
    rows.write.mode("append").json(path)


def session_usage(spark: SparkSession, path: str) -> DataFrame:
    """Tokens of each session file: every response is billed once by its ids."""
    usage = "struct<input_tokens:long,cache_creation_input_tokens:long,cache_read_input_tokens:long,output_tokens:long>"
    rows = spark.read.schema(f"requestId string, message struct<id:string,usage:{usage}>").json(path)
    once = rows.where("message.usage is not null").withColumn("session", F.col("_metadata.file_name")).dropDuplicates(["session", "requestId", "message"])
    last = F.row_number().over(Window.partitionBy("session", "requestId", "message.id").orderBy(F.desc("message.usage.output_tokens")))
    once = once.withColumn("place", last).where("place = 1")
    total = lambda name: F.coalesce(F.sum(f"message.usage.{name}"), F.lit(0))
    return once.groupBy("session").agg(
        F.count(F.lit(1)).alias("turns"), total("input_tokens").alias("input"), total("cache_creation_input_tokens").alias("cache_write"),
        total("cache_read_input_tokens").alias("cache_read"), total("output_tokens").alias("output"),
    )


def source_tree(spark: SparkSession, path: str, glob: str = "*.py", least: int = 2000, most: int = 400_000, sample: int | None = None, seed: int = 0) -> DataFrame:
    """(path, text) of source files in a size window, in order of path or as a seeded sample."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    rows = rows.where(F.col("length").between(least, most)).select("path", F.decode("content", "UTF-8").alias("text"))
    return rows.orderBy("path") if sample is None else rows.orderBy(F.xxhash64("path", F.lit(seed))).limit(sample)


def tree_fingerprint(files: DataFrame) -> DataFrame:
    """A hash of the sorted list of paths."""
    return files.agg(F.substring(F.sha2(F.array_join(F.array_sort(F.collect_list("path")), "\n"), 256), 1, 16).alias("fingerprint"))


def messages(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Line-delimited messages of both directions, as a table or a stream."""
    schema = "session string, seq long, dir string, id string, method string, tool string, args string, raw string, structured string"
    return (spark.readStream if streaming else spark.read).schema(schema).json(path)

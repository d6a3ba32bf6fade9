"""Scans: JSON lines, catalog tables, streams of tweets and control changes, players."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionwise.operators.enrich import validate_players
from mentionwise.schemas import CONTROL_CHANGE, PLAYERS, STREAM_TWEET, TWEETS_TABLE


def read_tweets(
    spark: SparkSession, path: str, schema: str = TWEETS_TABLE, recursive: bool = False
) -> DataFrame:
    """JSON-lines tweets with a declared schema.

    Hive-style directories are walked as they are and give their partition
    columns; ``recursive`` is for other layouts, where directory names carry
    no columns.
    """
    reader = spark.read.schema(schema).option("multiLine", "false")
    return reader.option("recursiveFileLookup", str(recursive).lower()).json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Raw feed messages, one JSON text per line, untouched."""
    return spark.read.text(path).withColumnRenamed("value", "payload")


def stream_json(
    spark: SparkSession, path: str, schema: str, max_files: int | None = None,
    latest_first: bool = False, max_bytes: str | None = None,
) -> DataFrame:
    """JSON-lines files as a stream; ``max_files`` or ``max_bytes`` bounds a micro-batch."""
    # copied or restored files keep old times: none is too old to be read
    reader = spark.readStream.schema(schema).option("latestFirst", str(latest_first).lower())
    reader = reader.option("maxFileAge", "36500d")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.json(path)


def stream_kafka(
    spark: SparkSession, servers: str, topic: str, schema: str, start: str = "latest",
    max_offsets: int | None = None,
) -> DataFrame:
    """JSON messages of a topic; ``start`` applies to a query without a checkpoint.

    The record's own ``arrival`` wins; without one, the broker's timestamp orders it.
    """
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", start)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    parsed = reader.load().select(
        F.from_json(F.col("value").cast("string"), schema).alias("r"),
        F.unix_millis("timestamp").alias("__at"),
    )
    rows = parsed.select("r.*", "__at")
    if "arrival" in rows.columns:
        rows = rows.withColumn("arrival", F.coalesce("arrival", "__at"))
    return rows.drop("__at")


def stream_tweets(spark: SparkSession, path: str, **options) -> DataFrame:
    return stream_json(spark, path, STREAM_TWEET, **options)


def stream_control(spark: SparkSession, path: str, **options) -> DataFrame:
    return stream_json(spark, path, CONTROL_CHANGE, **options)


def tweet_view(spark: SparkSession, rows: DataFrame, name: str, delay: str = "5 seconds") -> DataFrame:
    """Register hop rows with their watermark as a view for SQL queries."""
    marked = rows.withWatermark("event_time", delay) if rows.isStreaming else rows
    marked.createOrReplaceTempView(name)
    return marked


def read_players(spark: SparkSession, path: str) -> DataFrame:
    """``account;name;team`` lines; comment lines and lines that do not parse are skipped."""
    return (
        spark.read.schema(PLAYERS).option("sep", ";").option("mode", "DROPMALFORMED")
        .option("comment", "#").csv(path)
    )


def players_table(df: DataFrame) -> DataFrame:
    """A players dimension from any frame with the three columns, checked for its key."""
    return validate_players(df.select("account", "name", "team"))

"""Sinks: partitioned files, landing, side outputs, warehouse, notifications."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mentionwise.functions.columns import message_subject, message_text
from mentionwise.operators.ingest import (
    decode_payloads, decode_records, flat_json, observe_quality,
)
from mentionwise.operators.typed_load import check_totals, loadable, rejects, require_all
from mentionwise.schemas import DATE_PARTS, STATUS_OK
from mentionwise.session import exists, freeze, remove


def write_partitioned_json(
    df: DataFrame, path: str, keys: list[str] = DATE_PARTS, replace: bool = False,
    max_records_per_file: int = 0,
) -> None:
    """JSON files in hive-style directories.

    Adds files by default; ``replace`` overwrites just the partitions present
    in ``df``. The rebalance hint gathers a small partition into few files and
    still splits a big one over many tasks.
    """
    writer = df.hint("rebalance", *keys).write.partitionBy(*keys).option(
        "maxRecordsPerFile", max_records_per_file
    )
    if replace:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").json(path)
    else:
        writer.mode("append").json(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One micro-batch into its own folder: a replay overwrites, never repeats."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_text(df: DataFrame, path: str, keys: list[str], batch_id: int | str, name: str = "batch_id", **options: str) -> None:
    """Text lines partitioned by ``keys`` and batch, replayable."""
    keys = [*keys, name]
    (
        df.withColumn(name, F.lit(batch_id)).hint("rebalance", *keys)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .options(**options).partitionBy(*keys).text(path)
    )


def run_identity(spark: SparkSession, checkpoint: str) -> str:
    """A name that all runs of one checkpoint share and no other has, kept inside it.

    Batches of several checkpoints count from 0 each; with this name they can be
    written into one folder without taking each other's place.
    """
    path = f"{checkpoint}/identity"
    kept = spark.read.text(path).first() if exists(spark, path) else None
    if kept is None:
        spark.createDataFrame([(uuid.uuid4().hex,)], "value STRING").coalesce(1).write.mode("overwrite").text(path)
        kept = spark.read.text(path).first()
    return kept["value"]


def with_arrival(feed: DataFrame) -> DataFrame:
    """The stream with ``arrived_at``, unless its source has one.

    Set on the stream, not in the batch function: the query's log keeps the time of each
    batch, so a batch that is replayed, even on another day, has the same one again.
    """
    return feed if "arrived_at" in feed.columns else feed.withColumn("arrived_at", F.current_timestamp())


@dataclass
class Landing:
    """``foreachBatch`` function: good tweets, failed records and the untouched originals.

    Tweets are partitioned by the date inside the record; errors and originals
    by the time they arrived (``arrived_at``, see ``with_arrival``).
    Records come as base64 ``data`` or as plain ``payload`` text. A batch is told by
    ``run`` (see ``run_identity``) and its number. ``counts``: a folder for each batch's
    numbers of processed and failed records.
    """

    tweets: str
    errors: str | None = None
    originals: str | None = None
    run: str = ""
    counts: str | None = None

    def __call__(self, batch: DataFrame, batch_id: int | str) -> None:
        batch_id = f"{self.run}-{batch_id}" if self.run else batch_id
        if "arrived_at" not in batch.columns:
            batch = batch.withColumn("arrived_at", F.current_timestamp())
        encoded = "data" in batch.columns
        decode, original = (decode_records, "data") if encoded else (decode_payloads, "payload")
        quality = Observation("quality")
        decoded = observe_quality(flat_json(decode(batch)), quality).select(
            F.col(original).alias("original"),
            "flat", "status", "error_type", "arrived_at", *DATE_PARTS,
        ).persist()
        try:
            good = decoded.where(F.col("status") == STATUS_OK)
            write_text(good.select("flat", *DATE_PARTS), self.tweets, DATE_PARTS, batch_id)
            if self.errors:
                failed = decoded.where(F.col("status") != STATUS_OK).select(
                    "original", *self._arrival_parts(), F.col("error_type").alias("error")
                )
                write_text(failed, self.errors, [*DATE_PARTS, "error"], batch_id)
            if self.originals:
                write_text(decoded.select("original", *self._arrival_parts()), self.originals,
                            DATE_PARTS, batch_id, compression="gzip")
            if self.counts:
                # how many records the batch had, good and failed, as seen while it was written
                seen = quality.get
                batch.sparkSession.createDataFrame(
                    [(seen["processed"], seen["failed"])], "processed BIGINT, failed BIGINT"
                ).coalesce(1).write.mode("overwrite").parquet(f"{self.counts}/batch_id={batch_id}")
        finally:
            decoded.unpersist()

    @staticmethod
    def _arrival_parts():
        return [
            F.date_format("arrived_at", f).alias(p)
            for p, f in zip(DATE_PARTS, ("yyyy", "MM", "dd"))
        ]


def fan_out(*writers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """One ``foreachBatch`` function that feeds several; the batch is computed once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()
    return write


def run_available(df: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what the source holds now, then stop; the checkpoint remembers it."""
    query = (
        df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def write_json_stream(df: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Rows as JSON text lines to files."""
    return (
        df.select(F.to_json(F.struct("*")).alias("value")).writeStream.format("text")
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def write_kafka_stream(df: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Rows as JSON messages to a topic, all under the key "0" of the original feed."""
    return (
        df.select(F.lit("0").alias("key"), F.to_json(F.struct("*")).alias("value"))
        .writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("topic", topic).option("checkpointLocation", checkpoint).start()
    )


def print_stream(df: DataFrame, mode: str = "append", **trigger) -> StreamingQuery:
    return (
        df.writeStream.format("console").option("truncate", "false").outputMode(mode)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def event_lines(mentions: DataFrame) -> DataFrame:
    """Side-output text rows: source name, a space, destination name."""
    return mentions.select(F.concat_ws(" ", "src_name", "dst_name").alias("value"))


def notifications(detections: DataFrame) -> DataFrame:
    """One message per detection record."""
    return detections.select(
        message_subject().alias("subject"),
        message_text(
            F.col("team"), F.col("total"), F.col("tamperingPlayer"), F.col("players")
        ).alias("message"),
    )


VERSIONS_KEPT = 2


def latest_version(spark: SparkSession, path: str) -> int | None:
    if not exists(spark, f"{path}/committed"):
        return None
    records = spark.read.schema("version INT").option("recursiveFileLookup", "true").parquet(f"{path}/committed")
    return records.agg(F.max("version")).first()[0]


def write_version(df: DataFrame, path: str) -> int:
    """``df`` as the next version of the table at ``path``.

    The version counts once its record is there, and that is written last, as one
    file. Readers of the version before are not disturbed; older ones are removed.
    """
    spark = df.sparkSession
    last = latest_version(spark, path)
    version = 0 if last is None else last + 1
    df.write.mode("overwrite").parquet(f"{path}/data/{version}")
    record = spark.createDataFrame([(version,)], "version INT").coalesce(1)
    record.write.mode("overwrite").parquet(f"{path}/committed/{version}")
    if version >= VERSIONS_KEPT:
        for kind in ("data", "committed"):
            remove(spark, f"{path}/{kind}/{version - VERSIONS_KEPT}")
    return version


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The table's latest version that was written to its end."""
    version = latest_version(spark, path)
    if version is None:
        raise ValueError(f"no version at {path}")
    return spark.read.parquet(f"{path}/data/{version}")


def load_warehouse(
    totals: DataFrame, path: str, rejected: str | None = None, strict: bool = False,
    jdbc: dict[str, str] | None = None,
) -> None:
    """Replace the warehouse table with ``totals``, typed and checked.

    The rows become a new version of the table (see ``read_version``); a load that
    breaks off leaves the one before. ``strict`` fails on the first broken
    constraint; otherwise broken rows go to ``rejected``. With ``jdbc`` options the
    target is a database table, emptied rather than dropped.
    """
    checked = check_totals(totals)
    # a strict load is checked whole before the old table goes
    rows = freeze(require_all(checked), "strict-load") if strict else loadable(checked)
    if jdbc:
        rows.write.format("jdbc").options(**jdbc).option("truncate", "true").mode("overwrite").save()
    else:
        write_version(rows, path)
    if rejected and not strict:
        rejects(checked).write.mode("overwrite").json(rejected)

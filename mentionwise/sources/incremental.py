"""Incremental re-runs over a growing directory: enable, disable or pause the bookmark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionwise.session import exists

FILES = "path STRING, modified TIMESTAMP, bytes BIGINT"

Reader = Callable[[SparkSession, list[str], str], DataFrame]


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """FILES below ``path``; their content is not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


class Bookmark:
    """The files that finished runs have read, as a table of its own: one folder for each run.

    A run is recorded after its output is written. One that broke off is not, so its
    files are read again, under the same run number: output that is written by run
    number is replaced, not repeated. A file that is written anew counts as new.
    """

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.path = spark, f"{checkpoint}/files"

    def read(self) -> DataFrame:
        """FILES with the number of the run that read them."""
        schema = f"{FILES}, run INT"
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def next_run(self) -> int:
        last = self.read().agg(F.max("run")).first()[0]
        return 0 if last is None else last + 1

    def unread(self, files: DataFrame) -> DataFrame:
        return files.join(self.read().select("path", "modified"), ["path", "modified"], "left_anti")

    def commit(self, files: DataFrame, run: int) -> None:
        # one small file, so that a record is there as a whole or not at all
        files.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/run={run}")


def json_reader(schema: str) -> Reader:
    """JSON lines of the given files; ``base`` is where their partition folders begin."""
    return lambda spark, paths, base: spark.read.schema(schema).option("basePath", base).json(paths)


def read_lines(spark: SparkSession, paths: list[str], base: str) -> DataFrame:
    """Whole lines of the given files in ``value``, with the partition columns of their folders."""
    return spark.read.option("basePath", base).text(paths)


def run_incremental(
    spark: SparkSession, path: str, read: str | Reader, checkpoint: str | None,
    process: Callable[[DataFrame, int], None], bookmark: str = "disable",
) -> None:
    """Run ``process(rows, run)`` over ``path``; ``read`` is a schema of JSON lines or a reader.

    ``disable`` reads everything every time. ``enable`` reads the files not read
    before and remembers them. ``pause`` reads the files not read before without
    remembering them; the next enabled run has the same number and reads them again.
    """
    if bookmark not in ("enable", "pause", "disable"):
        raise ValueError(f"unknown bookmark mode {bookmark!r}")
    reader = json_reader(read) if isinstance(read, str) else read
    if bookmark == "disable":
        process(reader(spark, [path], path), Bookmark(spark, checkpoint).next_run() if checkpoint else 0)
        return
    marks = Bookmark(spark, checkpoint)
    run = marks.next_run()
    # the list is taken once: files that come later are the next run's. Spark's planner holds the
    # names of a scan's files on the driver as well
    new = [tuple(r) for r in marks.unread(list_files(spark, path)).collect()]
    if not new:
        if bookmark == "pause":
            process(reader(spark, [path], path).limit(0), run)
        return
    process(reader(spark, [n[0] for n in new], path), run)
    if bookmark == "enable":
        marks.commit(spark.createDataFrame(new, FILES), run)

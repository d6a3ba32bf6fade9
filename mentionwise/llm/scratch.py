"""Tables of finished steps: written to the shared folder, and removed once nothing reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mentionwise.session import scratch_path

# fixed value: Spark's setting by which a finished execution removes its shuffle files
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Writes the steps of one job and removes those that later steps no longer need.

    A step is a Parquet table in the folder that all executors share, so losing an
    executor never goes back beyond it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        before = self.spark.conf.get(CLEAN_UP, "false")
        # the step is on disk: the shuffles that led to it are of no further use
        self.spark.conf.set(CLEAN_UP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(CLEAN_UP, before)
        table = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(table)] = table, path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            _, path = self._paths.pop(id(table))
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)

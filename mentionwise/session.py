"""Session settings, the shared scratch folder and frozen intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # 'month=08' must stay the string '08'
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a batch commits what it changed, not all the state it holds
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # a repeated JSON key keeps its last value instead of failing the record
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job here relies on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and stream checkpoints.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    master may fall back to a temporary folder: on a cluster a machine-local
    path would be lost with the machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="mentionwise-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def freeze(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder (or ``path``) once and read it back.

    Cuts lineage the way a reliable checkpoint does, but columnar: later
    passes read only the columns they need, and losing an executor never
    re-evaluates what led here.
    """
    path = path or scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    """The Hadoop file system and path: the store that Spark's readers and writers use."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _at(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more; fine if it is not there."""
    files, target = _at(spark, path)
    files.delete(target, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

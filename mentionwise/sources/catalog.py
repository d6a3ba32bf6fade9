"""Catalog tables over JSON directories: creation, partition registration, schema drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from mentionwise.schemas import DATE_PARTS, TOTALS, TWEETS_TABLE


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def create_json_table(
    spark: SparkSession, name: str, location: str, schema: str = TOTALS,
    partitions: list[str] = (),
) -> None:
    """External JSON table, created only when it is absent."""
    by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    columns = _columns(StructType.fromDDL(schema))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING json {by} LOCATION '{location}'"
    )


def register_tweets(
    spark: SparkSession, name: str, location: str, schema: str = TWEETS_TABLE, keys: list[str] = DATE_PARTS
) -> None:
    """Create the partitioned tweets table if needed and pick up new date folders.

    Existing columns and partitions are left alone; see :func:`schema_drift`.
    """
    create_json_table(spark, name, location, schema, keys)
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def discover_schema(spark: SparkSession, location: str, sampling: float = 1.0) -> StructType:
    """Infer the schema of a directory: one extra pass, for discovery only."""
    return spark.read.option("samplingRatio", sampling).json(location).schema


def schema_drift(spark: SparkSession, stored: StructType, found: StructType) -> DataFrame:
    """What discovery would change: ``(column, stored, found, change)``, nothing applied."""
    old = {f.name: f.dataType.simpleString() for f in stored}
    new = {f.name: f.dataType.simpleString() for f in found}
    rows = [
        (c, old.get(c), new.get(c),
         "added" if c not in old else "missing" if c not in new else "type")
        for c in sorted({*old, *new}) if old.get(c) != new.get(c)
    ]
    return spark.createDataFrame(rows, "column STRING, stored STRING, found STRING, change STRING")


def insert_totals(totals: DataFrame, name: str, replace_days: bool = False) -> None:
    """Append by position, so running a day twice stores it twice.

    ``replace_days`` is the re-runnable variant for a table partitioned by day:
    it overwrites the days present in ``totals`` only.
    """
    if not replace_days:
        totals.write.insertInto(name)
        return
    spark = totals.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # an insert takes it from the session only
    try:
        totals.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)

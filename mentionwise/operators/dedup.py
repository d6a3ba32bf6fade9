"""Duplicate removal by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionwise.operators.ingest import once
from mentionwise.schemas import DATE_PARTS


def drop_duplicates(df: DataFrame, keys: list[str] = ("id",)) -> DataFrame:
    """One arbitrary row per key; rows with a null key collapse into one."""
    return df.dropDuplicates(list(keys))


def latest_per_key(
    df: DataFrame, keys: list[str] = ("id",), newest: str = "created_at"
) -> DataFrame:
    """One row per key: the newest, ties broken by the rest of the row.

    An aggregate rather than a ranking window: copies are reduced to one row
    per key and map task before the shuffle, so a key that holds a third of
    the table never reaches one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c != newest]
    winner = F.max(F.struct(newest, *rest)).alias("w")
    return df.groupBy(*keys).agg(winner).select(*keys, "w.*").select(*df.columns)


def whole_records(lines: DataFrame) -> DataFrame:
    """JSON lines in ``value`` with ``id``, ``created_at`` and the date parts, the text untouched.

    Only these fields are looked at, so whatever else a record holds stays as it was
    written. Date parts come from the folders where these have them, else from the
    record. ``is_record`` is false for text that is not one JSON object.
    """
    schema = "id STRING, created_at STRING, year STRING, month STRING, day STRING, _corrupt STRING"
    told = once(lines, "told", F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt"}))
    parts = [
        (F.coalesce(p, f"told.{p}") if p in lines.columns else F.col(f"told.{p}")).alias(p) for p in DATE_PARTS
    ]
    opens = F.ltrim("value").startswith("{")
    return told.select(
        "value", "told.id", "told.created_at", *parts,
        (opens & F.col("told").isNotNull() & F.col("told._corrupt").isNull()).alias("is_record"),
    )


def latest_records(records: DataFrame) -> DataFrame:
    """One whole record per id: the newest, ties broken by its text; those without an id collapse into one.

    Copies are reduced to one per id and map task before the shuffle.
    """
    winner = F.max(F.struct("created_at", "value", *DATE_PARTS)).alias("w")
    return records.groupBy("id").agg(winner).select("id", "w.*")


def drop_duplicates_stream(
    df: DataFrame, keys: list[str] = ("id",), event_time: str = "event_time",
    within: str = "1 hour",
) -> DataFrame:
    """Streaming form: copies arriving within ``within`` of each other, bounded state."""
    return df.withWatermark(event_time, within).dropDuplicatesWithinWatermark(list(keys))

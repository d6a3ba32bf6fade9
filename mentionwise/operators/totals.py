"""Athlete mentions per player and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionwise.functions.columns import is_athlete
from mentionwise.schemas import DATE_PARTS


def daily_player_totals(
    tweets: DataFrame, year: str | None = None, month: str | None = None, day: str | None = None
) -> DataFrame:
    """Count annotations (an athlete tagged twice in one tweet counts twice).

    Explode, filter and the partial count run in one generated stage, which is
    faster than filtering inside the array. Day parameters filter the grouping
    keys after the aggregation; Catalyst moves them down to the partition
    directories.
    """
    named = tweets.select(
        *DATE_PARTS, F.explode("context_annotations").alias("context")
    ).where(is_athlete(F.col("context")))
    totals = named.groupBy(*DATE_PARTS, F.col("context.entity.name").alias("player")).agg(
        F.count("*").cast("int").alias("total")
    )
    for part, value in zip(DATE_PARTS, (year, month, day)):
        if value is not None:
            totals = totals.where(F.col(part) == value)
    return totals

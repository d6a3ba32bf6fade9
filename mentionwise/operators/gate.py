"""The control gate: tweets of a team pass unless its latest control says it is allowed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionwise.operators.running import running, slice_by
from mentionwise.session import freeze

TWEET, CONTROL = 1, 0


def decode_control(changes: DataFrame) -> DataFrame:
    """Change records to ``(team, allowed)``; a removal takes the permission back."""
    removed = F.col("eventName") == "REMOVE"
    new, old = F.col("dynamodb")["NewImage"], F.col("dynamodb")["OldImage"]
    return changes.select(
        F.when(removed, old["team"]["S"]).otherwise(new["team"]["S"]).alias("team"),
        F.when(removed, F.lit(False)).otherwise(new["control"]["BOOL"]).alias("allowed"),
        "arrival",
        F.col("eventID").alias("id"),
    )


ARRIVAL = ["arrival", "kind", "id"]


def with_control(mentions: DataFrame, control: DataFrame) -> DataFrame:
    """Tweets and control values as rows of one frame (or stream), told apart by ``kind``."""
    return mentions.withColumn("kind", F.lit(TWEET)).unionByName(
        control.select(
            F.col("team").alias("src_team"), "arrival", "id",
            F.lit(CONTROL).alias("kind"), F.col("allowed").alias("control"),
        ),
        allowMissingColumns=True,
    )


def resolve_control(mixed: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """The tweets of sliced ``mixed`` rows with ``allowed``, the control value they met.

    As-of join by arrival order, the control first on a tie; absent means not
    allowed. Few teams hold all the rows, so this is a sliced running value,
    not a window per team. ``start`` holds the values left by earlier batches.
    The rows keep their arrival slices for the steps that follow.
    """
    seen = running(mixed, ["src_team"], ARRIVAL, {"allowed": ("last", F.col("control"))})
    tweets = seen.where(F.col("kind") == TWEET).drop("kind", "control")
    if start is not None:
        earlier = start.select(F.col("src_team").alias("__team"), F.col("allowed").alias("__start"))
        tweets = tweets.join(
            earlier, tweets["src_team"].eqNullSafe(earlier["__team"]), "left"
        ).withColumn("allowed", F.coalesce("allowed", "__start")).drop("__team", "__start")
    return tweets.withColumn("allowed", F.coalesce("allowed", F.lit(False)))


def latest_control(mixed: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """The value each team's next tweet will meet: ``(src_team, allowed)``."""
    values = mixed.where((F.col("kind") == CONTROL) & F.col("control").isNotNull()).select(
        "src_team", "arrival", "id", F.col("control").alias("allowed"), F.lit(1).alias("batch")
    )
    if start is not None:
        values = values.unionByName(
            start.withColumn("batch", F.lit(0)), allowMissingColumns=True
        )
    newest = F.max_by("allowed", F.struct("batch", "arrival", "id"))
    return values.groupBy("src_team").agg(newest.alias("allowed"))


def passing(resolved: DataFrame) -> DataFrame:
    return resolved.where(~F.col("allowed")).drop("allowed")


def control_state(
    mentions: DataFrame, control: DataFrame, slices: int | None = None
) -> DataFrame:
    # slicing reads its rows twice: once for the bounds, which a sample gives
    mixed = freeze(with_control(mentions, control), "mixed")
    return resolve_control(slice_by(mixed, ARRIVAL, slices))


def gate(mentions: DataFrame, control: DataFrame, slices: int | None = None) -> DataFrame:
    return passing(control_state(mentions, control, slices))

"""Checks on the way into the typed warehouse table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionwise.schemas import WAREHOUSE_TEXT_BYTES

_NUMBERS = ["year", "month", "day", "total"]


def check_totals(totals: DataFrame) -> DataFrame:
    """Cast to the warehouse types; ``reject`` names the first broken constraint."""
    typed = totals.select(
        *[F.col(c).try_cast("int").alias(c) for c in ("year", "month", "day")],
        "player", F.col("total").try_cast("int").alias("total"),
        F.struct(*[F.col(c).cast("string").alias(c) for c in totals.columns]).alias("source"),
    )
    reject = F.lit(None).cast("string")
    for c in reversed(_NUMBERS):
        reject = F.when(F.col(c).isNull(), c).otherwise(reject)
    reject = F.when(
        F.col("player").isNull() | (F.octet_length("player") > WAREHOUSE_TEXT_BYTES), "player"
    ).otherwise(reject)
    return typed.withColumn("reject", reject)


def loadable(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reject").isNull()).drop("reject", "source")


def rejects(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reject").isNotNull()).select("source.*", "reject")


def require_all(checked: DataFrame) -> DataFrame:
    """Strict mode: a broken constraint stops the load, as the warehouse would."""
    return loadable(checked.withColumn(
        "total",
        F.when(F.col("reject").isNull(), F.col("total")).otherwise(
            F.raise_error(F.concat(F.lit("constraint broken: "), F.col("reject"))).cast("int")
        ),
    ).withColumn("reject", F.lit(None).cast("string")))

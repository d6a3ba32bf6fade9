"""Running aggregates over an ordered key, without putting a key into one task.

``Window.partitionBy(key).orderBy(order)`` sends every row of a key to one
task; with a handful of teams, or one global clock, that is the whole job.
Here the rows are range-partitioned by their order into slices of about equal
size, so a (key, slice) pair is bounded however hot the key is. Each pair is
summarised, the summaries are accumulated per key, and the running value of a
row is its slice's carried-in value combined with the rows of its own slice.

Slices depend on the order only: steps that share an order share the slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionwise.session import freeze, shuffle_partitions

SLICE = "__slice"
_ROW = "__is_row"


def slice_by(
    df: DataFrame, order: list[str], slices: int | None = None, path: str | None = None
) -> DataFrame:
    """Add ``__slice``: contiguous ranges of ``order``, numbered upwards.

    ``order`` should identify a row, so that equal leading values can still be
    split. The result is written once to the shared scratch folder: range
    bounds come from a sample, and every later pass must see the same slices.
    ``path`` names another place, for a caller that deletes them.
    """
    # more slices than tasks, so that hashing them to tasks stays even
    slices = slices or 2 * shuffle_partitions(df.sparkSession)
    ranged = df.repartitionByRange(slices, *order).withColumn(SLICE, F.spark_partition_id())
    return freeze(ranged, "slices", path)


def _by_slice(df: DataFrame) -> DataFrame:
    """Whole slices per task, whatever the key: the windows of all steps share one shuffle."""
    return df.repartition(shuffle_partitions(df.sparkSession), SLICE)


def _summary(how: str, value: Column, order: list[str]) -> Column:
    if how == "max":
        return F.max(value)
    if how == "last":
        return F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))
    return F.count(value)


def _carried(how: str, summary: Column, window) -> Column:
    if how == "max":
        return F.max(summary).over(window)
    if how == "last":
        return F.last(summary, ignorenulls=True).over(window)
    return F.sum(summary).over(window)


def _within(how: str, value: Column, carry: Column, window) -> Column:
    if how == "max":
        return F.greatest(carry, F.max(value).over(window))
    if how == "last":
        return F.coalesce(F.last(value, ignorenulls=True).over(window), carry)
    return F.coalesce(carry, F.lit(0)) + F.count(value).over(window)


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    outputs: dict[str, tuple[str, Column]],
    inclusive: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Add running columns to ``df``, per ``keys``, in ``order`` (which must be unique per key).

    ``outputs`` maps a new column to ``(how, value)`` with ``how`` one of
    ``max``, ``last`` (last non-null) or ``count`` (non-null). By default a row sees only the rows before it;
    ``inclusive`` adds the row itself. Rows that carry slices of a compatible
    order keep them; others are sliced here.
    """
    if SLICE not in df.columns:
        sliced = running(slice_by(df, order, slices), keys, order, outputs, inclusive)
        return sliced.drop(SLICE)

    rows = df.withColumns({f"__in_{name}": value for name, (_, value) in outputs.items()})
    summaries = rows.groupBy(*keys, SLICE).agg(*[
        _summary(how, F.col(f"__in_{name}"), order).alias(f"__sum_{name}")
        for name, (how, _) in outputs.items()
    ])
    before = (
        Window.partitionBy(*keys).orderBy(SLICE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    seeds = summaries.select(
        *keys, SLICE, F.lit(0).alias(_ROW),
        *[_carried(how, F.col(f"__sum_{name}"), before).alias(f"__seed_{name}")
          for name, (how, _) in outputs.items()],
    )

    # the seed row sorts first in its slice, so every row after it can read the carried value
    last_row = Window.currentRow if inclusive else Window.currentRow - 1
    here = (
        Window.partitionBy(*keys, SLICE).orderBy(_ROW, *order)
        .rowsBetween(Window.unboundedPreceding, last_row)
    )
    united = _by_slice(rows.withColumn(_ROW, F.lit(1))).unionByName(
        _by_slice(seeds), allowMissingColumns=True
    )
    result = united.withColumns({
        name: _within(how, F.col(f"__in_{name}"), F.first(f"__seed_{name}").over(here), here)
        for name, (how, _) in outputs.items()
    })
    return result.where(F.col(_ROW) == 1).select(*df.columns, *outputs)

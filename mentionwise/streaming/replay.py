"""Replay of stored rows as a stream: arrival-ordered portions of files, one run per portion."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionwise.session import freeze


def portions(order: DataFrame, column: str, count: int) -> list[tuple[int | None, int | None]]:
    """``count`` half-open ranges of ``column`` that hold about equally many rows."""
    shares = [i / count for i in range(1, count)]
    cuts = order.agg(F.percentile_approx(column, shares).alias("c")).first()["c"] or []
    edges = [None, *cuts, None]
    return list(zip(edges[:-1], edges[1:]))


def spread(feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Each feed derived once and dealt out evenly: every portion is a filter over stored rows.

    A table may be one file that a single task reads; what follows is not bound to that task.
    """
    return {path: freeze(rows.hint("rebalance"), "feed") for path, rows in feeds.items()}


def replay(
    feeds: dict[str, DataFrame], step: Callable[[], None], order: str = "arrival", count: int = 3
) -> None:
    """Append each feed (``path -> rows``) portion by portion as JSON lines, then run ``step``.

    Portions are cut on the largest feed's ``order`` column and written one
    after the other, so a later run never sees an earlier arrival. Within a
    portion the files are written in parallel.
    """
    feeds = spread(feeds)
    first = next(iter(feeds.values()))
    for low, high in portions(first, order, count):
        for path, rows in feeds.items():
            part = rows
            if low is not None:
                part = part.where(F.col(order) > low)
            if high is not None:
                part = part.where(F.col(order) <= high)
            part.write.mode("append").json(path)
        step()

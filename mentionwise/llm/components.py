"""Connected components of a link table, and joins that stand a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionwise.session import freeze

# keys with more than this share of all rows are joined by broadcast; there are at most as many of them
HEAVY_KEYS = 1000


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the undirected links ``a, b`` (longs).

    In each round every node moves onto the neighbour (or itself) that comes first
    in an order drawn anew by hashing, and the links are contracted. The graph
    shrinks by a constant factor a round whatever its shape; hubs only ever meet a
    partial minimum. Both tables of a round are written to the shared folder.
    """
    links = freeze(_tidy(links.select("a", "b")), "links")
    moves: list[DataFrame] = []
    while not links.isEmpty():
        seed = F.lit(len(moves))
        both = links.union(links.select("b", "a"))
        order = F.struct(F.xxhash64("b", seed).alias("h"), F.col("b").alias("node"))
        own = F.struct(F.xxhash64("a", seed).alias("h"), F.col("a").alias("node"))
        move = both.groupBy(F.col("a").alias("node")).agg(F.min(F.least(order, own))["node"].alias("to"))
        moves.append(move := freeze(move, "moves"))
        for end in ("a", "b"):
            links = links.join(move.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("to", end)
        links = freeze(_tidy(links), "links")
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    root = moves.pop()
    root = root.select("node", F.col("to").alias("root"))
    while moves:
        step = moves.pop().join(root.withColumnRenamed("node", "to"), "to", "left")
        root = freeze(step.select("node", F.coalesce("root", "to").alias("root")), "roots")
    return root


def _tidy(links: DataFrame) -> DataFrame:
    ends = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ends.distinct()


def join_counted(rows: DataFrame, facts: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """``rows`` with the ``facts`` of their ``key``; ``n`` in facts: how many rows carry the key.

    Keys of more than one in HEAVY_KEYS rows, at most that many, are broadcast; the
    rest is a shuffled join in which no key is large.
    """
    most = total // HEAVY_KEYS
    heavy = facts.where(F.col(n) > most)
    return (
        rows.join(F.broadcast(heavy), key).unionByName(
            rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
            .join(facts.where(F.col(n) <= most), key)
        )
    )

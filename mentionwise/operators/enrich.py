"""The players dimension and the two lookups that turn a tweet into a mention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionwise.functions.columns import event_timestamp, first_athlete, first_username

# a lookup side is broadcast only when it was measured below both bounds
BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 1_000_000


def duplicate_accounts(players: DataFrame) -> DataFrame:
    return players.groupBy("account").agg(F.count("*").alias("n")).where("n > 1")


def validate_players(players: DataFrame) -> DataFrame:
    """The dimension is keyed by account; refuse one that is not."""
    repeated = [r["account"] for r in duplicate_accounts(players).limit(5).collect()]
    if repeated:
        raise ValueError(f"players.account is not unique, for example {repeated}")
    return players


def players_by_name(players: DataFrame) -> DataFrame:
    """One player per name: the one with the smallest account."""
    first = F.min(F.struct("account", "team")).alias("p")
    return players.groupBy("name").agg(first).select("name", "p.account", "p.team")


def fits_broadcast(
    df: DataFrame, max_bytes: int = BROADCAST_BYTES, max_rows: int = BROADCAST_ROWS
) -> bool:
    """Measure ``df`` (string columns) in one distributed pass instead of trusting an estimate."""
    widths = [F.coalesce(F.octet_length(c), F.lit(0)) for c in df.columns]
    size = df.agg(
        F.count(F.lit(1)).alias("n"), F.sum(sum(widths[1:], widths[0])).alias("bytes")
    ).first()
    return size["n"] <= max_rows and (size["bytes"] or 0) <= max_bytes


def lookup(
    facts: DataFrame, side: DataFrame, key: str, side_key: str,
    broadcast: bool, salts: int = 1, spread: str = "id",
) -> DataFrame:
    """Left join to a keyed side: broadcast when it was measured small, else shuffled.

    The shuffled form relies on adaptive skew handling in batch. A stream has
    none, so there a hot key is spread with ``salts``: each fact row takes one
    salt from a hash of ``spread`` and the side is repeated once per salt.
    """
    side_cols = [c for c in side.columns if c != side_key]
    if broadcast:
        side = F.broadcast(side)
        return facts.join(side, facts[key] == side[side_key], "left").drop(side_key)
    if salts > 1:
        facts = facts.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
        side = side.withColumn("__salt_side", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        match = (facts[key] == side[side_key]) & (facts["__salt"] == side["__salt_side"])
        joined = facts.join(side, match, "left")
    else:
        joined = facts.join(side, facts[key] == side[side_key], "left")
    kept = [c for c in facts.columns if c != "__salt"]
    return joined.select(*kept, *side_cols)


def mentions(tweets: DataFrame) -> DataFrame:
    """Stream tweets to flat mentions: first user, first athlete, normalised event time."""
    tweet = F.get(F.col("data"), F.lit(0))
    return tweets.select(
        tweet["id"].alias("id"),
        "arrival",
        event_timestamp(F.col("event_time"), tweet["created_at"]).alias("event_time"),
        first_username(F.col("includes")["users"]).alias("account"),
        first_athlete(tweet["context_annotations"]).alias("athlete"),
    )


def enrich(
    flat: DataFrame, players: DataFrame, salts: int = 1, broadcast: bool | None = None
) -> DataFrame:
    """Attach source and destination players to mentions.

    ``miss`` is NULL for a complete mention and otherwise says which lookup
    found nothing; such rows go to quarantine instead of failing the job.
    """
    by_name = players_by_name(players)
    if broadcast is None:
        # the by-name view is never larger than the dimension it is taken from
        broadcast = fits_broadcast(players.select("account", "name", "team"))
    source = players.select(
        F.col("account").alias("__account"),
        F.col("name").alias("src_name"), F.col("team").alias("src_team"),
        F.lit(True).alias("__src"),
    )
    target = by_name.select(
        F.col("name").alias("__name"),
        F.col("account").alias("dst_account"), F.col("team").alias("dst_team"),
        F.lit(True).alias("__dst"),
    )
    joined = lookup(flat, source, "account", "__account", broadcast, salts)
    joined = lookup(joined, target, "athlete", "__name", broadcast, salts)
    miss = (
        F.when(F.col("event_time").isNull(), "event_time")
        .when(F.col("__src").isNull(), "source")
        .when(F.col("athlete").isNull(), "athlete")
        .when(F.col("__dst").isNull(), "destination")
    )
    return joined.select(
        "id", "arrival", "event_time",
        F.col("account").alias("src_account"), "src_name", "src_team",
        "dst_account", F.col("athlete").alias("dst_name"), "dst_team",
        miss.alias("miss"),
    )


def matched(enriched: DataFrame) -> DataFrame:
    """The complete mentions, without the ``miss`` column."""
    return enriched.where(F.col("miss").isNull()).drop("miss")


def quarantined(enriched: DataFrame) -> DataFrame:
    return enriched.where(F.col("miss").isNotNull())

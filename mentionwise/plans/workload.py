"""Mention data derived from the driver's tables, whole tables each.

Every shape the jobs read - feed messages, stream tweets, control changes,
players, annotated tweets - is a projection of a given table, so the work
grows with the tables. Some rows are spoiled on purpose to reach the error,
quarantine and reject paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mentionwise.functions.columns import date_parts
from mentionwise.operators.ingest import plain_base64

# arrival lags the event by up to this many seconds, so that some rows are late
MAX_LAG_SECONDS = 21_600


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def player_name(key: Column) -> Column:
    return F.concat(F.lit("Customer#"), F.lpad(key.cast("string"), 9, "0"))


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return (
        customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        .join(region, nation["n_regionkey"] == region["r_regionkey"])
        .select(
            F.col("c_custkey").cast("string").alias("account"),
            F.col("c_name").alias("name"), F.col("r_name").alias("team"),
        )
    )


def _annotation(domain: Column, entity: Column) -> Column:
    empty = F.lit(None).cast("string")
    return F.struct(
        F.struct(domain.alias("id"), empty.alias("name"), empty.alias("description")).alias("domain"),
        F.struct(empty.alias("id"), entity.alias("name"), empty.alias("description")).alias("entity"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    lag = F.pmod(F.col("event_id") * 7919, F.lit(MAX_LAG_SECONDS)) * 1000
    return table(spark, sf_dir, "events").select(
        F.col("event_id"),
        F.col("event_id").cast("string").alias("id"),
        at.alias("at"),
        F.unix_millis(at).alias("event_ms"),
        (F.unix_millis(at) + lag).alias("arrival"),
        "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def tweet_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).where(~F.col("event_type").isin("signup", "error"))


def _annotations() -> Column:
    """One non-athlete and two athlete annotations; some athletes are unknown or missing."""
    spoil = F.pmod("event_id", F.lit(40))
    other = _annotation(F.lit("3"), F.concat(F.lit("Show#"), F.col("k").cast("string")))
    first = F.when(spoil == 9, F.concat(F.lit("Nobody#"), F.col("k").cast("string"))).otherwise(
        player_name(F.pmod("k", F.lit(20)))
    )
    second = player_name(F.pmod(F.col("k") * 7 + 3, F.lit(100)))
    return F.when(spoil == 11, F.array(other)).otherwise(F.array(
        other, _annotation(F.lit("60"), first), _annotation(F.lit("60"), second),
    ))


def stream_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream tweets, some from accounts nobody knows, some at impossible times."""
    user = F.col("user_id").cast("string")
    account = F.when(F.pmod("event_id", F.lit(40)) == 7, F.concat(F.lit("ghost-"), user)).otherwise(user)
    # a time that no timestamp can hold
    at = F.when(F.pmod("event_id", F.lit(40)) == 13, F.lit("9" * 17)).otherwise(F.col("event_ms").cast("string"))
    return tweet_events(spark, sf_dir).select(
        at.alias("event_time"),
        "arrival",
        F.array(F.struct(
            F.col("id").alias("id"), F.col("event_type").alias("text"),
            F.lit(None).cast("string").alias("created_at"),
            _annotations().alias("context_annotations"),
        )).alias("data"),
        F.struct(F.array(F.struct(account.alias("username"))).alias("users")).alias("includes"),
    )


def flat_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tweets as landed: flat and dated."""
    created = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return tweet_events(spark, sf_dir).select(
        "event_id", "id", F.col("event_type").alias("text"), created.alias("created_at"),
        _annotations().alias("context_annotations"),
    ).withColumns(date_parts(F.col("created_at")))


def control_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of the control table: sign-ups allow a team, errors disallow it."""
    team = players(spark, sf_dir).select(F.col("account").alias("__account"), F.col("team"))
    events = _events(spark, sf_dir).where(F.col("event_type").isin("signup", "error"))
    known = events.join(team, events["user_id"].cast("string") == team["__account"])
    removed = (F.col("event_type") == "error") & (F.col("k") % 2 == 0)
    image = F.struct(
        F.struct(F.col("team").alias("S")).alias("team"),
        F.struct((F.col("event_type") == "signup").alias("BOOL")).alias("control"),
    )
    return known.select(
        F.when(removed, "REMOVE").when(F.col("event_type") == "signup", "INSERT")
        .otherwise("MODIFY").alias("eventName"),
        F.col("id").alias("eventID"),
        "arrival",
        F.struct(
            F.when(~removed, image).alias("NewImage"), F.when(removed, image).alias("OldImage"),
        ).alias("dynamodb"),
    )


def annotated_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat tweets with a list of annotations each: one per line item, dated by shipment."""
    line = table(spark, sf_dir, "lineitem")
    flag = (
        F.when(F.col("l_returnflag") == "R", "60").when(F.col("l_returnflag") == "A", "3")
        .otherwise("46")
    )
    status = F.when(F.col("l_linestatus") == "O", "60").otherwise("47")
    first = player_name(F.pmod("l_suppkey", F.lit(20)))
    second = player_name(F.pmod("l_partkey", F.lit(20)))
    created = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return line.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("id"),
        created.alias("created_at"),
        F.when(F.col("l_quantity") < 3, F.lit(None)).otherwise(
            F.array(_annotation(flag, first), _annotation(status, second))
        ).alias("context_annotations"),
    ).withColumns(date_parts(F.col("created_at")))


def repeated_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tweets of which every fifth came twice, and some without an id."""
    events = _events(spark, sf_dir).select(
        F.when(F.pmod("event_id", F.lit(97)) != 0, F.col("id")).alias("id"),
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("created_at"),
        F.col("event_type").alias("text"),
        F.col("user_id").cast("string").alias("author_id"),
        "event_id", "at",
    )
    again = events.where(F.pmod("event_id", F.lit(5)) == 0).withColumn(
        "created_at",
        F.date_format(F.col("at") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
    )
    return events.unionByName(again).drop("event_id", "at")


def _q(text: str) -> Column:
    return F.lit(text)


def feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed messages as JSON text, every seventh spoiled in one of eight ways.

    The text is put together by hand so that its bytes are known.
    """
    events = _events(spark, sf_dir)
    kind = F.pmod("event_id", F.lit(56))
    created = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'.000Z'")
    created = (
        F.when(kind == 14, _q(""))
        .when(kind == 42, _q(',"created_at":5'))
        .when(kind == 49, _q(',"created_at":"20"'))
        .otherwise(F.concat(_q(',"created_at":"'), created, _q('"')))
    )
    tweet = F.concat(
        _q('{"id":"'), F.col("id"), _q('","text":"'), F.col("event_type"), _q('"'), created,
        _q(',"extra":{"k":'), F.col("k").cast("string"), _q("}}"),
    )
    related = F.when(
        F.pmod("event_id", F.lit(4)) == 0,
        F.concat(_q(',"tweets":[{"id":"r'), F.col("id"),
                 _q('","text":"related","created_at":"2023-12-31T00:00:00.000Z"}]')),
    ).otherwise(_q(""))
    users = F.concat(_q('"users":[{"id":"'), F.col("user_id").cast("string"), _q('"}]'))
    main = F.concat(_q('{"data":['), tweet, _q('],"includes":{'), users, related, _q("}}"))
    payload = (
        F.when(kind == 7, _q("not json {"))
        .when(kind == 21, F.concat(_q('{"data":[],"includes":{'), users, _q("}}")))
        .when(kind == 28, F.concat(_q('{"data":['), tweet, _q("]}")))
        .when(kind == 35, _q('{"data":null}'))
        .when(F.pmod("event_id", F.lit(3)) == 1, tweet)
        .otherwise(main)
    )
    # white space around a record and a byte-order mark before it do not spoil it
    payload = (
        F.when(kind == 1, F.concat(_q("\t "), payload, _q(" "))).when(kind == 2, F.concat(_q("\ufeff"), payload))
        .otherwise(payload)
    )
    return events.select(
        F.col("id").alias("recordId"), payload.alias("payload"), F.col("event_id"),
        F.col("at").alias("arrived_at"),
    )


def envelope_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed messages as base64 records; some are not base64 at all."""
    return feed_messages(spark, sf_dir).select(
        "recordId",
        F.when(F.pmod("event_id", F.lit(56)) == 0, _q("%%%not base64"))
        .otherwise(plain_base64(F.col("payload"))).alias("data"),
        "arrived_at",
    )


def raw_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals as text, some of which break a warehouse constraint."""
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    player = (
        F.when(F.pmod(key, F.lit(13)) == 0, F.lit(None))
        .when(F.pmod(key, F.lit(17)) == 0, F.repeat(F.lit("é"), 128))
        .otherwise(player_name(F.col("o_custkey")))
    )
    return table(spark, sf_dir, "orders").select(
        F.when(F.pmod(key, F.lit(11)) == 0, "x").otherwise(F.substring(day, 1, 4)).alias("year"),
        F.substring(day, 6, 2).alias("month"), F.substring(day, 9, 2).alias("day"),
        player.alias("player"),
        F.when(F.pmod(key, F.lit(19)) == 0, "12x").otherwise(F.floor("o_totalprice").cast("string")).alias("total"),
    )

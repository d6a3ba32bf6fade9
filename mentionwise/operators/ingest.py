"""Raw records to flat tweets: decode, flatten, date-stamp, keep the failures."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from mentionwise.functions.columns import date_parts
from mentionwise.schemas import (
    DATE_PARTS, DETECTION, FEED_RULE, FLAT_TWEET, STATUS_FAILED, STATUS_OK, TWEET_FIELDS,
)


def base64_text(data: Column) -> Column:
    """Base64 to UTF-8 text, NULL where it is neither.

    Characters outside the alphabet are skipped and the padding must be
    complete; the clean-up runs only for values that do not decode as they are.
    """
    def strict(col: Column) -> Column:
        return F.when(F.length(col) % 4 == 0, F.try_to_binary(col, F.lit("base64")))

    cleaned = F.regexp_replace(data, "[^A-Za-z0-9+/=]", "")
    return F.try_validate_utf8(F.coalesce(strict(data), strict(cleaned)).cast("string"))


def plain_base64(text: Column) -> Column:
    """UTF-8 text to base64 on one line."""
    return F.translate(F.base64(F.encode(text, "utf-8")), "\r\n", "")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is evaluated once per row, however often it is used.

    Catalyst inlines a projected expression into the filters above it, which
    here would parse the same JSON text many times. It does not inline what a
    generator produced.
    """
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def decode_records(records: DataFrame) -> DataFrame:
    """``(recordId, data)`` to one row per record with ``status`` and the flat tweet.

    Adds ``payload`` (the decoded text), ``status``, ``error_type`` and, for good
    records, ``users`` and the tweet itself as VARIANT (so fields nobody
    declared survive) with ``created_at`` and its date parts. A bad record never
    fails the job: it keeps its original ``data``.
    """
    return decode_payloads(once(records, "payload", base64_text(F.col("data"))))


def json_text(payload: Column) -> Column:
    """A JSON text without the white space around it and a byte-order mark before it."""
    bare = F.when(payload.startswith("\ufeff"), F.substring(payload, 2, 2**31 - 1)).otherwise(payload)
    return F.btrim(bare, F.lit(" \t\r\n"))


def decode_payloads(messages: DataFrame) -> DataFrame:
    """:func:`decode_records` for records whose ``payload`` is text already."""
    kept = [c for c in messages.columns if c != "payload"] + ["payload"]

    # one JSON object and nothing after it: as a one-element list, trailing text does not parse
    text = json_text(F.col("payload"))
    listed = F.try_parse_json(F.when(
        text.startswith("{") & text.endswith("}"), F.concat(F.lit("["), text, F.lit("]"))
    ))
    parsed = once(messages, "listed", listed)
    single = F.try_variant_get("listed", "$[1]", "variant").isNull()
    parsed = once(parsed, "body", F.when(single, F.try_variant_get("listed", "$[0]", "variant")))

    # the key's presence decides: `"data": null` is a broken main record, not a related one
    has_data = F.try_variant_get("body", "$.data", "variant").isNotNull()
    parsed = once(parsed, "parts", F.struct(
        has_data.alias("is_main"),
        F.when(has_data, F.try_variant_get("body", "$.data[0]", "variant"))
        .otherwise(F.col("body")).alias("tweet"),
        F.when(has_data, F.try_variant_get("body", "$.includes.users", "variant")).alias("users"),
    ))

    created = F.try_variant_get("parts.tweet", "$.created_at", "variant")
    error = (
        F.when(F.col("payload").isNull(), "encoding")
        .when(F.col("body").isNull(), "json")
        .when(F.col("parts.tweet").isNull(), "data")
        .when(F.col("parts.is_main") & F.col("parts.users").isNull(), "users")
        .when(created.isNull() | (F.schema_of_variant(created) != "STRING"), "created_at")
    )
    judged = once(parsed, "verdict", F.struct(
        error.alias("error_type"),
        F.try_variant_get("parts.tweet", "$.created_at", "string").alias("created_at"),
    ))
    ok = F.col("verdict.error_type").isNull()
    return judged.select(
        *kept, "parts.*", "verdict.error_type",
        F.when(ok, STATUS_OK).otherwise(STATUS_FAILED).alias("status"),
        F.when(ok, F.col("verdict.created_at")).alias("created_at"),
    ).withColumns(date_parts(F.col("created_at")))


def flat_json(decoded: DataFrame) -> DataFrame:
    """Add ``flat``: the output tweet as JSON text, every original field kept."""
    added = ["users", *DATE_PARTS]
    fields = F.try_variant_get("tweet", "$", "map<string,variant>")
    dated = F.create_map(
        *[x for p in DATE_PARTS for x in (F.lit(p), F.col(p).cast("variant"))]
    )
    main = F.map_concat(
        F.map_filter(fields, lambda k, _: ~k.isin(added)),
        F.create_map(F.lit("users"), F.col("users")), dated,
    )
    related = F.map_concat(F.map_filter(fields, lambda k, _: ~k.isin(DATE_PARTS)), dated)
    return decoded.withColumn(
        "flat",
        F.when(F.col("status") == STATUS_OK,
               F.to_json(F.when(F.col("is_main"), main).otherwise(related))),
    )


def good_tweets(decoded: DataFrame) -> DataFrame:
    """The typed flat tweets of the records that decoded."""
    ok = flat_json(decoded).where(F.col("status") == STATUS_OK)
    return ok.select(
        "recordId", F.from_json("flat", FLAT_TWEET).alias("t"), *DATE_PARTS
    ).select("recordId", "t.*", *DATE_PARTS)


def encode_records(decoded: DataFrame) -> DataFrame:
    """``(recordId, result, data)``: re-encoded tweets, failures with their input unchanged."""
    again = plain_base64(F.col("flat"))
    return flat_json(decoded).select(
        "recordId",
        F.col("status").alias("result"),
        F.when(F.col("status") == STATUS_OK, again).otherwise(F.col("data")).alias("data"),
    )


def status_counts(decoded: DataFrame) -> DataFrame:
    return decoded.groupBy("status", F.coalesce("error_type", F.lit("")).alias("error_type")).agg(
        F.count("*").alias("records")
    )


def observe_quality(decoded: DataFrame, name: str | Observation = "quality") -> DataFrame:
    """Attach processed / failed counters to the job that consumes ``decoded``."""
    failed = F.count_if(F.col("status") != STATUS_OK)
    return decoded.observe(
        name, failed.alias("failed"), (F.count(F.lit(1)) - failed).alias("processed")
    )


def with_related(feed: DataFrame) -> DataFrame:
    """Main feed messages plus one record per related tweet, as JSON ``payload`` rows.

    ``feed`` holds raw messages in ``payload``. A related tweet has no ``data`` key.
    """
    related = F.try_variant_get(
        F.try_parse_json(json_text(F.col("payload"))), "$.includes.tweets", "array<variant>"
    )
    return feed.withColumn(
        "payload",
        F.explode(F.concat(
            F.array("payload"),
            F.coalesce(F.transform(related, lambda t: F.to_json(t)),
                       F.array().cast("array<string>")),
        )),
    )


def typed_tweets(text: Column) -> Column:
    """The fields the feed is asked for, as a typed struct."""
    return F.from_json(text, TWEET_FIELDS)


def match_rules(
    df: DataFrame, text: str = "text", rules: Iterable[tuple[str, str]] = (FEED_RULE,)
) -> DataFrame:
    """Keep rows whose text holds a rule's word (whole word, any case); collect the tags.

    A search stops at the first hit, so a long text is rarely read to its end.
    """
    def holds(rule: str) -> Column:
        return F.col(text).rlike(rf"(?i)(?<!\w)\Q{rule}\E(?!\w)")

    tags = F.array_compact(F.array(*[F.when(holds(rule), tag) for rule, tag in rules]))
    return once(df, "tags", tags).where(F.size("tags") > 0)


def decode_detections(records: DataFrame) -> DataFrame:
    """Base64 detection payloads in ``data`` to detection columns."""
    return records.select(F.from_json(base64_text(F.col("data")), DETECTION).alias("d")).select("d.*")

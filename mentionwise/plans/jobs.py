"""The user-level jobs, each one composition of sources, operators and sinks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from mentionwise.operators.dedup import latest_records, whole_records
from mentionwise.operators.enrich import enrich, fits_broadcast, matched, mentions, quarantined
from mentionwise.operators.gate import decode_control, gate, with_control
from mentionwise.operators.ingest import decode_detections, with_related
from mentionwise.operators.totals import daily_player_totals
from mentionwise.operators.windows import (
    classify, detect, detect_stream, hop_mentions, hop_rows, late_rows, windowed_rows, with_clock,
)
from mentionwise.schemas import (
    DATE_PARTS, DELAY_SECONDS, HOP_DELAY_SECONDS, HOP_SIZE_SECONDS, HOP_SLIDE_SECONDS, HOP_THRESHOLD,
    LATENESS_SECONDS, RAW_TOTALS, TWEETS_TABLE, WINDOW_SECONDS,
)
from mentionwise.sinks.writers import (
    Landing, load_warehouse, notifications, run_available, run_identity, with_arrival, write_text,
)
from mentionwise.sources.catalog import create_json_table, insert_totals, register_tweets
from mentionwise.sources.incremental import read_lines, run_incremental
from mentionwise.streaming.detector import Detector
from mentionwise.streaming.gate import gate_stream


def land_tweets(
    feed: DataFrame, out: str, errors: str, originals: str, checkpoint: str, counts: str | None = None
) -> StreamingQuery:
    """Feed messages (``payload``) and their related tweets into date partitions.

    Feeds with checkpoints of their own may land in the same folders.
    """
    run = run_identity(feed.sparkSession, checkpoint)
    return run_available(with_related(with_arrival(feed)), checkpoint, Landing(out, errors, originals, run, counts))


def dedupe_tweets(
    spark: SparkSession, source: str, out: str, table: str,
    bookmark: str = "disable", checkpoint: str | None = None, broken: str | None = None,
) -> None:
    """Drop duplicate tweets by id, rewrite them by date, then register the new folders.

    Records are rewritten as they came, with fields nobody declared; lines that are no
    record go to ``broken``. A run of the bookmark writes under its own number (a
    further partition, ``run``), so one that is repeated replaces what it had written.
    Registration comes last, so it happens only when the rewrite succeeded.
    """
    by_run = bookmark != "disable"

    def rewrite(lines: DataFrame, run: int) -> None:
        records = whole_records(lines)
        kept = latest_records(records.where("is_record")).select("value", *DATE_PARTS)
        if by_run:
            write_text(kept, out, DATE_PARTS, run, name="run")
        else:
            kept.hint("rebalance", *DATE_PARTS).write.mode("append").partitionBy(*DATE_PARTS).text(out)
        if broken:
            records.where("NOT is_record").select("value").write.mode("overwrite").text(f"{broken}/run={run}")

    run_incremental(spark, source, read_lines, checkpoint, rewrite, bookmark)
    keys = [*DATE_PARTS, "run"] if by_run else DATE_PARTS
    register_tweets(spark, table, out, TWEETS_TABLE + (", run STRING" if by_run else ""), keys)


def store_daily_totals(
    spark: SparkSession, tweets: str, totals: str, location: str,
    year: str, month: str, day: str,
) -> None:
    """Create the totals table if missing and append one day."""
    create_json_table(spark, totals, location)
    insert_totals(daily_player_totals(spark.table(tweets), year, month, day), totals)


def load_totals(
    spark: SparkSession, source: str, target: str, rejected: str | None = None,
    strict: bool = False,
) -> None:
    """Totals JSON, by field name, replaces the typed warehouse table."""
    load_warehouse(spark.read.schema(RAW_TOTALS).json(source), target, rejected, strict)


def mention_windows(
    tweets: DataFrame, size: int = HOP_SIZE_SECONDS, slide: int = HOP_SLIDE_SECONDS,
    delay: int = HOP_DELAY_SECONDS, threshold: int = HOP_THRESHOLD,
) -> DataFrame:
    """Hopping-window mention counts, batch or stream."""
    rows = hop_rows(tweets)
    if tweets.isStreaming:
        rows = rows.withWatermark("event_time", f"{delay} seconds")
    return hop_mentions(rows, size, slide, threshold)


def mention_windows_sql(
    spark: SparkSession, view: str, size: int = HOP_SIZE_SECONDS,
    slide: int = HOP_SLIDE_SECONDS, threshold: int = HOP_THRESHOLD,
) -> DataFrame:
    """The same query as SQL over a view of hop rows (see ``tweet_view``)."""
    return spark.sql(
        f"""
        SELECT window.end AS event_time, username AS sourceplayer,
               player AS destinationplayer, count(*) AS total
        FROM IDENTIFIER(:view)
        GROUP BY window(event_time, '{int(size)} seconds', '{int(slide)} seconds'), username, player
        HAVING count(*) > {int(threshold)}
        """,
        args={"view": view},
    )


def detect_tampering(
    tweets: DataFrame, changes: DataFrame, players: DataFrame,
    window: int = WINDOW_SECONDS, lateness: int = LATENESS_SECONDS, delay: int = DELAY_SECONDS,
    threshold: int = 1, clock: str = "global",
) -> dict[str, DataFrame]:
    """Batch detector: final ``results``, ``late`` and ``windowed`` rows, ``quarantine``."""
    enriched = enrich(mentions(tweets), players)
    passed = gate(matched(enriched), decode_control(changes))
    rows = classify(with_clock(passed, clock), window, lateness, delay)
    return {
        "results": detect(windowed_rows(rows), window, threshold),
        "late": late_rows(rows),
        "windowed": windowed_rows(rows),
        "quarantine": quarantined(enriched),
    }


def detect_tampering_stream(
    tweets: DataFrame, changes: DataFrame, players: DataFrame | Callable[[], DataFrame], out: str,
    checkpoint: str, detector: Detector | None = None,
) -> StreamingQuery:
    """Streaming detector: results with revisions, late and windowed rows, quarantine under ``out``.

    ``players`` as a function is read again in every batch (see ``Detector``).
    """
    read = players if callable(players) else lambda: players
    detector = replace(detector or Detector(out, f"{checkpoint}-state"), players=read)
    mixed = with_control(mentions(tweets), decode_control(changes))
    return run_available(mixed, checkpoint, detector)


def gated_stream(
    tweets: DataFrame, changes: DataFrame, players: DataFrame, salts: int = 8
) -> DataFrame:
    """Streaming front half with keyed state: enrich, then gate; a stream of passing mentions."""
    enriched = enrich(mentions(tweets), players, salts=salts, broadcast=fits_broadcast(players))
    return gate_stream(matched(enriched), decode_control(changes), salts)


def gated_windows_stream(
    tweets: DataFrame, changes: DataFrame, players: DataFrame, window: int = WINDOW_SECONDS,
    delay: int = DELAY_SECONDS, threshold: int = 1, salts: int = 8,
) -> DataFrame:
    """Gate, watermark and window as stateful steps of one stream: a row per closed window.

    Mentions behind the watermark are dropped for good. What should be kept apart or
    revise a result is the detector's work (see ``detect_tampering_stream``).
    """
    enriched = enrich(mentions(tweets), players, salts=salts, broadcast=fits_broadcast(players))
    passed = gate_stream(matched(enriched), decode_control(changes), salts, delay)
    return detect_stream(passed, window, threshold)


def quarantine_stream(
    tweets: DataFrame, players: DataFrame, out: str, checkpoint: str, salts: int = 8
) -> StreamingQuery:
    """The mentions no player could be found for, as their own stream."""
    missed = quarantined(
        enrich(mentions(tweets), players, salts=salts, broadcast=fits_broadcast(players))
    )
    query = (
        missed.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    return query


def final_detections_stream(
    passed: DataFrame, window: int = WINDOW_SECONDS, lateness: int = LATENESS_SECONDS,
    delay: int = DELAY_SECONDS, threshold: int = 1,
) -> DataFrame:
    """One row per closed window: the watermark follows the gate and waits for the lateness."""
    marked = passed.withWatermark("event_time", f"{delay + lateness} seconds")
    return detect_stream(marked, window, threshold)


def notify(records: DataFrame) -> DataFrame:
    """Base64 detection records to ``(subject, message)`` rows."""
    return notifications(decode_detections(records))

"""Every query by name: a callable from (spark, directory of tables) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionwise.functions.columns import athletes, event_timestamp, first_athlete, names_text
from mentionwise.operators import dedup, typed_load
from mentionwise.operators.enrich import (
    enrich, fits_broadcast, matched, mentions, players_by_name, quarantined,
)
from mentionwise.operators.gate import control_state, decode_control, gate
from mentionwise.operators.ingest import (
    decode_payloads, decode_records, encode_records, good_tweets, match_rules, plain_base64, status_counts,
    typed_tweets, with_related,
)
from mentionwise.operators.totals import daily_player_totals
from mentionwise.operators.windows import (
    classify, detect, detection_records, firings, hop_mentions, hop_rows, late_rows, windowed_rows,
    windowed_rows_with_refires, with_clock,
)
from mentionwise.plans import jobs, workload
from mentionwise.schemas import DATE_PARTS, DETECTION, HOP_COUNTS, RAW_TOTALS, TOTALS, TWEETS_TABLE
from mentionwise.session import configure, freeze, scratch_path
from mentionwise.sinks.writers import (
    Landing, event_lines, notifications, read_version, run_available, write_batch, write_partitioned_json,
)
from mentionwise.sources.catalog import (
    create_json_table, discover_schema, insert_totals, register_tweets, schema_drift,
)
from mentionwise.sources.incremental import run_incremental
from mentionwise.sources.readers import (
    players_table, read_players, read_tweets, stream_control, stream_json, stream_tweets,
    tweet_view,
)
from mentionwise.streaming.detector import Detector, committed
from mentionwise.streaming.replay import replay, spread

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Timing:
    """Seconds; wide, because the given events are minutes apart."""

    window: int = 43_200
    lateness: int = 5_400
    delay: int = 1_800
    hop_size: int = 172_800
    hop_slide: int = 86_400
    # above the largest arrival lag, so that the watermark drops nothing
    stream_delay: int = 25_200


T = Timing()
# rules of the keyword query, with their tags
RULES = [("the", "english"), ("der", "german"), ("data", "data")]
TOTALS_DAY = ("1998", "08", "09")

_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    _registry[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_registry)


# ---- clean-up and totals ----------------------------------------------------

@query
def daily_totals(spark, d):
    return daily_player_totals(workload.annotated_tweets(spark, d))


@query
def daily_totals_one_day(spark, d):
    return daily_player_totals(workload.annotated_tweets(spark, d), *TOTALS_DAY)


@query
def first_athlete_vs_all(spark, d):
    tweets = workload.annotated_tweets(spark, d)
    found = athletes(F.col("context_annotations"))
    return tweets.select(
        "id", first_athlete(F.col("context_annotations")).alias("first_athlete"),
        F.coalesce(F.size(found), F.lit(0)).cast("bigint").alias("athletes"),
    )


@query
def dedupe_by_id(spark, d):
    return dedup.latest_per_key(workload.repeated_tweets(spark, d))


@query
def dedupe_ids(spark, d):
    return dedup.drop_duplicates(workload.repeated_tweets(spark, d)).select("id")


@query
def envelope_status(spark, d):
    return status_counts(decode_records(workload.envelope_records(spark, d)))


@query
def envelope_flat(spark, d):
    good = good_tweets(decode_records(workload.envelope_records(spark, d)))
    user = F.get("users", F.lit(0))["id"].alias("first_user")
    return good.select("recordId", "id", "text", "created_at", user, *DATE_PARTS)


@query
def envelope_extra_fields(spark, d):
    decoded = decode_records(workload.envelope_records(spark, d)).where("status = 'Ok'")
    return decoded.select(
        "recordId", F.try_variant_get("tweet", "$.extra.k", "bigint").alias("k")
    )


@query
def reencode_records(spark, d):
    sent = encode_records(decode_records(workload.envelope_records(spark, d)))
    again = typed_tweets(F.try_to_binary("data", F.lit("base64")).cast("string"))
    ok = F.col("result") == "Ok"
    return sent.select(
        "recordId", "result",
        F.when(ok, again["id"]).alias("id"),
        F.when(~ok, F.col("data")).alias("unchanged"),
    )


@query
def related_fanout(spark, d):
    messages = with_related(workload.feed_messages(spark, d))
    good = decode_payloads(messages).where("status = 'Ok'")
    return good.select(
        "recordId", F.try_variant_get("tweet", "$.id", "string").alias("id"), *DATE_PARTS
    )


@query
def event_time_forms(spark, d):
    events = workload.tweet_events(spark, d)
    iso = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    created = F.date_format("at", "yyyy-MM-dd'T'00:00:00.000'Z'")
    form = F.pmod("event_id", F.lit(3))
    text = F.when(form == 0, F.col("event_ms").cast("string")).when(form == 1, iso)
    at = event_timestamp(text, created)
    return events.select("id", F.unix_millis(at).alias("event_ms"))


@query
def keyword_rule(spark, d):
    found = match_rules(workload.table(spark, d, "documents"), "text", RULES)
    return found.select("doc_id", F.array_join(F.array_sort("tags"), ",").alias("tags"))


@query
def typed_rows(spark, d):
    return typed_load.loadable(typed_load.check_totals(workload.raw_totals(spark, d)))


@query
def typed_rejects(spark, d):
    return typed_load.rejects(typed_load.check_totals(workload.raw_totals(spark, d)))


# ---- players and mentions ---------------------------------------------------

def _enriched(spark, d):
    return enrich(mentions(workload.stream_tweets(spark, d)), workload.players(spark, d))


def _plain(rows: DataFrame) -> DataFrame:
    """Mention rows with the event time in millis, the columns every mention query returns."""
    return rows.select(
        "id", "arrival", F.unix_millis("event_time").alias("event_ms"),
        "src_account", "src_name", "src_team", "dst_account", "dst_name", "dst_team",
    )


def _passed(spark, d):
    return gate(
        matched(_enriched(spark, d)), decode_control(workload.control_changes(spark, d))
    )


def _classified(spark, d, clock="global"):
    """Mentions past the gate with their clock, window and flags."""
    return classify(with_clock(_passed(spark, d), clock), T.window, T.lateness, T.delay)


def _readable(found: DataFrame, *extra: str) -> DataFrame:
    return found.select(
        "team", "tamperingPlayer", F.col("total").cast("bigint").alias("total"),
        names_text(F.col("names")).alias("players"), "window_start", "window_end", *extra,
    )


@query
def players_names(spark, d):
    return players_by_name(workload.players(spark, d))


@query
def enrich_players(spark, d):
    return _plain(matched(_enriched(spark, d)))


@query
def enrich_shuffled(spark, d):
    flat = mentions(workload.stream_tweets(spark, d))
    return _plain(matched(enrich(flat, workload.players(spark, d), salts=4, broadcast=False)))


@query
def enrich_quarantine(spark, d):
    return quarantined(_enriched(spark, d)).select("id", "src_account", "dst_name", "miss")


@query
def control_decode(spark, d):
    return decode_control(workload.control_changes(spark, d))


@query
def control_gate(spark, d):
    state = control_state(
        matched(_enriched(spark, d)), decode_control(workload.control_changes(spark, d))
    )
    return state.select("id", "src_team", "arrival", "allowed")


# ---- windows ----------------------------------------------------------------

@query
def hop_counts(spark, d):
    rows = hop_rows(workload.stream_tweets(spark, d))
    return _hop_plain(hop_mentions(rows, T.hop_size, T.hop_slide))


@query
def hop_counts_sql(spark, d):
    tweet_view(spark, hop_rows(workload.stream_tweets(spark, d)), "hop_rows")
    return _hop_plain(jobs.mention_windows_sql(spark, "hop_rows", T.hop_size, T.hop_slide))


def _hop_plain(found: DataFrame) -> DataFrame:
    return found.withColumn("event_time", F.unix_millis("event_time"))


@query
def tumbling_tampering(spark, d):
    return _readable(detect(matched(_enriched(spark, d)), T.window))


@query
def tampering_final(spark, d):
    return _readable(detect(windowed_rows(_classified(spark, d)), T.window))


@query
def tampering_revisions(spark, d):
    return _readable(firings(freeze(_classified(spark, d), "classified"), T.delay), "revision")


@query
def late_events(spark, d):
    return _plain(late_rows(_classified(spark, d)))


@query
def late_events_team_clock(spark, d):
    return _plain(late_rows(_classified(spark, d, "team")))


@query
def late_event_lines(spark, d):
    lines = event_lines(late_rows(_classified(spark, d)))
    return lines.groupBy("value").agg(F.count("*").alias("lines"))


@query
def windowed_events(spark, d):
    return _plain(windowed_rows(_classified(spark, d)))


@query
def windowed_events_with_refires(spark, d):
    rows = windowed_rows_with_refires(freeze(_classified(spark, d), "classified"))
    return rows.select("id", "src_team", "dst_name", "window_start",
                       F.col("firing").cast("bigint").alias("firing"))


@query
def detection_lines(spark, d):
    found = detection_records(detect(matched(_enriched(spark, d)), T.window))
    return found.withColumn("total", F.col("total").cast("bigint"))


@query
def notify_messages(spark, d):
    return notifications(detection_records(detect(matched(_enriched(spark, d)), T.window)))


@query
def notify_records(spark, d):
    found = detection_records(detect(matched(_enriched(spark, d)), T.window))
    sent = found.select(plain_base64(F.to_json(F.struct("*"))).alias("data"))
    return jobs.notify(sent)


# ---- sinks, catalog and re-runs ---------------------------------------------

def _landed(spark, d, feeds: int = 1):
    """The feed, dealt to as many checkpoints, all landing in the same folders."""
    feed, root = scratch_path(spark, "feed"), scratch_path(spark, "landed")
    for n in range(feeds):
        part = workload.feed_messages(spark, d).where(F.pmod("event_id", F.lit(feeds)) == n)
        part.select("payload").write.text(f"{feed}/{n}")
        jobs.land_tweets(
            spark.readStream.text(f"{feed}/{n}").withColumnRenamed("value", "payload"),
            f"{root}/tweets", f"{root}/errors", f"{root}/originals", f"{root}/checkpoint/{n}", f"{root}/counts",
        )
    return root


def _landed_days(spark, root):
    landed = read_tweets(spark, f"{root}/tweets")
    return landed.groupBy(*DATE_PARTS).agg(
        F.count("*").alias("tweets"), F.count("users").alias("main_tweets")
    )


@query
def landed_tweets(spark, d):
    return _landed_days(spark, _landed(spark, d))


@query
def landed_two_runs(spark, d):
    return _landed_days(spark, _landed(spark, d, feeds=2))


@query
def landed_accounting(spark, d):
    counts = spark.read.parquet(f"{_landed(spark, d, feeds=2)}/counts")
    return counts.agg(F.sum("processed").alias("processed"), F.sum("failed").alias("failed"))


@query
def landed_errors(spark, d):
    root = scratch_path(spark, "landed")
    Landing(f"{root}/tweets", f"{root}/errors", f"{root}/originals")(
        workload.envelope_records(spark, d), 0
    )
    return spark.read.text(f"{root}/errors").select(
        *DATE_PARTS, "error", F.col("value").alias("data")
    )


@query
def landed_originals(spark, d):
    root = scratch_path(spark, "landed")
    Landing(f"{root}/tweets", None, f"{root}/originals")(workload.envelope_records(spark, d), 0)
    return spark.read.text(f"{root}/originals").select(*DATE_PARTS, F.col("value").alias("data"))


@query
def deduped_table(spark, d):
    root = scratch_path(spark, "dedupe")
    tweets = workload.flat_tweets(spark, d)
    again = tweets.where(F.pmod("event_id", F.lit(5)) == 0)
    write_partitioned_json(tweets.unionByName(again).drop("event_id"), f"{root}/raw")
    name = f"tweets_{root.rsplit('-', 1)[1]}"
    jobs.dedupe_tweets(spark, f"{root}/raw", f"{root}/clean", name)
    return daily_player_totals(spark.table(name))


@query
def deduped_extra_fields(spark, d):
    """Fields that no schema names, nested ones too, after duplicate removal."""
    root = scratch_path(spark, "dedupe")
    k = F.col("k")
    tweets = workload.flat_tweets(spark, d).join(
        workload.tweet_events(spark, d).select("event_id", "k"), "event_id"
    ).withColumns({
        "public_metrics": F.struct((k * 2).alias("like_count"), F.array(k, k + 1).alias("by_day")),
        "extra": F.struct(k.alias("k")),
    }).drop("k")
    again = tweets.where(F.pmod("event_id", F.lit(5)) == 0)
    write_partitioned_json(tweets.unionByName(again).drop("event_id"), f"{root}/raw")
    jobs.dedupe_tweets(spark, f"{root}/raw", f"{root}/clean", f"extra_{root.rsplit('-', 1)[1]}")
    body = F.try_parse_json("value")
    return spark.read.text(f"{root}/clean").select(
        F.try_variant_get(body, "$.id", "string").alias("id"), F.try_variant_get(body, "$.extra.k", "bigint").alias("k"),
        F.try_variant_get(body, "$.public_metrics.like_count", "bigint").alias("likes"),
        F.try_variant_get(body, "$.public_metrics.by_day[1]", "bigint").alias("second_day"), *DATE_PARTS,
    )


@query
def totals_table(spark, d):
    root = scratch_path(spark, "totals")
    name = f"totals_{root.rsplit('-', 1)[1]}"
    totals = daily_player_totals(workload.annotated_tweets(spark, d))
    create_json_table(spark, name, root)
    for _ in range(2):
        insert_totals(totals, name)
    return spark.table(name)


def _warehouse(spark, d, loads: int = 1) -> str:
    root = scratch_path(spark, "warehouse")
    workload.raw_totals(spark, d).write.json(f"{root}/totals")
    for _ in range(loads):
        jobs.load_totals(spark, f"{root}/totals", f"{root}/table", f"{root}/rejected")
    return root


@query
def warehouse_rejects(spark, d):
    """What the load refused, values as they were written."""
    return spark.read.schema(f"{RAW_TOTALS}, reject STRING").json(f"{_warehouse(spark, d)}/rejected")


@query
def warehouse_load(spark, d):
    return read_version(spark, f"{_warehouse(spark, d, loads=3)}/table").groupBy("year", "month").agg(
        F.count("*").alias("loaded"), F.sum("total").alias("total")
    )


@query
def players_file(spark, d):
    path = scratch_path(spark, "players")
    lines = workload.players(spark, d).select(F.concat_ws(";", "account", "name", "team"))
    comment = lines.limit(1).select(F.lit("# account;name;team"))
    lines.union(comment).toDF("value").write.text(path)
    return read_players(spark, path)


@query
def discovered_drift(spark, d):
    root = scratch_path(spark, "discover")
    tweets = workload.flat_tweets(spark, d).select(
        "id", "created_at", F.col("event_id").alias("position"), *DATE_PARTS
    )
    write_partitioned_json(tweets, root)
    name = f"found_{root.rsplit('-', 1)[1]}"
    register_tweets(spark, name, root, "id STRING, created_at STRING, lang STRING, "
                    "year STRING, month STRING, day STRING")
    return schema_drift(spark, spark.table(name).schema, discover_schema(spark, root))


def _two_runs(spark, d, *bookmarks: str) -> DataFrame:
    """Land the tweets in two halves and count each run's under its bookmark mode."""
    root = scratch_path(spark, "incremental")
    tweets = workload.flat_tweets(spark, d)

    def add(rows: DataFrame, batch_id: int) -> None:
        write_batch(daily_player_totals(rows), f"{root}/totals", batch_id)

    odd = F.pmod("event_id", F.lit(2)) == 1
    for half, bookmark in zip((odd, ~odd), bookmarks):
        write_partitioned_json(tweets.where(half).drop("event_id"), f"{root}/tweets")
        run_incremental(spark, f"{root}/tweets", TWEETS_TABLE, f"{root}/checkpoint", add, bookmark)
    return spark.read.schema(TOTALS).parquet(f"{root}/totals").select(*DATE_PARTS, "player", "total")


@query
def incremental_totals(spark, d):
    return _two_runs(spark, d, "enable", "enable")


@query
def bookmark_paused(spark, d):
    """A paused run after an enabled one reads the second half; both outputs stay."""
    return _two_runs(spark, d, "enable", "pause")


# ---- streams ----------------------------------------------------------------

def _stream(spark, d, run: Callable[[DataFrame, DataFrame, DataFrame, str], None]) -> str:
    """Replay tweets and control changes as files; ``run`` is started once per portion."""
    root = scratch_path(spark, "stream")
    players = workload.players(spark, d)
    replay(
        {f"{root}/in/tweets": workload.stream_tweets(spark, d),
         f"{root}/in/control": workload.control_changes(spark, d)},
        lambda: run(stream_tweets(spark, f"{root}/in/tweets"),
                    stream_control(spark, f"{root}/in/control"), players, root),
    )
    return root


def _append(df: DataFrame, root: str) -> None:
    (
        df.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    )


@query
def hop_stream(spark, d):
    def run(tweets, _changes, _players, root):
        _append(jobs.mention_windows(tweets, T.hop_size, T.hop_slide, T.stream_delay), root)

    return _hop_plain(spark.read.schema(HOP_COUNTS).parquet(f"{_stream(spark, d, run)}/out"))


@query
def tumbling_stream(spark, d):
    broadcast = fits_broadcast(workload.players(spark, d))

    def run(tweets, _changes, players, root):
        rows = matched(enrich(mentions(tweets), players, salts=4, broadcast=broadcast))
        _append(jobs.final_detections_stream(rows, T.window, 0, T.stream_delay), root)

    return _readable(spark.read.parquet(f"{_stream(spark, d, run)}/out"))


@query
def control_gate_stream(spark, d):
    def run(tweets, changes, players, root):
        passed = jobs.gated_stream(tweets, changes, players, salts=4)
        run_available(passed, f"{root}/checkpoint",
                      lambda batch, batch_id: write_batch(batch, f"{root}/out", batch_id))

    return _plain(spark.read.parquet(f"{_stream(spark, d, run)}/out"))


def _in_halves(spark, d, root, step: Callable[[DataFrame, DataFrame, int], None]) -> None:
    """Replay in two portions, cut in the middle of the arrival times; ``step`` runs after each."""
    feeds = spread({"tweets": workload.stream_tweets(spark, d), "control": workload.control_changes(spark, d)})
    span = feeds["tweets"].agg(F.min("arrival").alias("a"), F.max("arrival").alias("b")).first()
    first = F.col("arrival") <= ((span["a"] or 0) + (span["b"] or 0)) // 2
    for n, part in enumerate((first, ~first)):
        for name, rows in feeds.items():
            rows.where(part).write.mode("append").json(f"{root}/in/{name}")
        step(stream_tweets(spark, f"{root}/in/tweets"), stream_control(spark, f"{root}/in/control"), n)


@query
def gated_windows_stream(spark, d):
    """Gate, watermark and window on one stream; what comes behind the watermark is dropped."""
    root = scratch_path(spark, "gated-windows")

    def step(tweets, changes, _):
        _append(jobs.gated_windows_stream(tweets, changes, workload.players(spark, d), T.window, T.delay, salts=4), root)

    _in_halves(spark, d, root, step)
    return _readable(spark.read.parquet(f"{root}/out"))


def _detector_stream(spark, d, clock="global"):
    def run(tweets, changes, players, root):
        detector = Detector(f"{root}/out", f"{root}/state", T.window, T.lateness, T.delay, clock=clock)
        jobs.detect_tampering_stream(
            tweets, changes, players, f"{root}/out", f"{root}/checkpoint", detector
        )

    return f"{_stream(spark, d, run)}/out"


@query
def revisions_stream(spark, d):
    return _readable(spark.read.parquet(f"{_detector_stream(spark, d)}/results"), "revision")


@query
def late_stream(spark, d):
    return _plain(spark.read.parquet(f"{_detector_stream(spark, d)}/late"))


@query
def windowed_stream_team_clock(spark, d):
    return _plain(spark.read.parquet(f"{_detector_stream(spark, d, 'team')}/windowed"))


@query
def detector_quarantine(spark, d):
    """Mentions without a player, from the run that also gives the results."""
    rows = committed(spark, _detector_stream(spark, d), "quarantine")
    return rows.select("id", "src_account", "dst_name", "miss")


@query
def detector_result_lines(spark, d):
    """The published JSON lines, read back."""
    lines = committed(spark, _detector_stream(spark, d), "result_lines")
    found = lines.select(F.from_json("value", DETECTION).alias("r")).select("r.*")
    return found.withColumn("total", F.col("total").cast("bigint"))


@query
def detector_new_player(spark, d):
    """Every seventh player joins between two runs; only mentions before that stay without them."""
    root = scratch_path(spark, "new-player")
    everyone = workload.players(spark, d)
    joins_later = F.pmod(F.col("account").cast("bigint"), F.lit(7)) == 3

    def step(tweets, changes, n):
        everyone.where(joins_later if n else ~joins_later).write.mode("append").parquet(f"{root}/players")
        jobs.detect_tampering_stream(
            tweets, changes, lambda: players_table(spark.read.parquet(f"{root}/players")), f"{root}/out",
            f"{root}/checkpoint", Detector(f"{root}/out", f"{root}/state", T.window, T.lateness, T.delay),
        )

    _in_halves(spark, d, root, step)
    return committed(spark, f"{root}/out", "quarantine").select("id", "src_account", "dst_name", "miss")


@query
def quarantine_stream(spark, d):
    def run(tweets, _changes, players, root):
        jobs.quarantine_stream(tweets, players, f"{root}/out", f"{root}/checkpoint", salts=4)

    rows = spark.read.parquet(f"{_stream(spark, d, run)}/out")
    return rows.select("id", "src_account", "dst_name", "miss")


@query
def dedupe_stream(spark, d):
    root = scratch_path(spark, "dedupe-stream")
    events = workload.tweet_events(spark, d).select(
        "id", F.col("event_ms").cast("string").alias("event_time"), "arrival", "user_id"
    )
    again = events.withColumn("arrival", F.col("arrival") + 3_600_000)

    def run():
        rows = stream_json(spark, f"{root}/in", "id STRING, event_time STRING, user_id BIGINT")
        timed = rows.withColumn("event_time", event_timestamp(F.col("event_time")))
        _append(dedup.drop_duplicates_stream(timed, ["id"], within=f"{T.stream_delay} seconds"), root)

    replay({f"{root}/in": events.unionByName(again)}, run)
    return spark.read.parquet(f"{root}/out").select("id", "user_id")

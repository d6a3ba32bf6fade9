"""Streaming forms give what the batch forms give, however the input is cut into batches."""

import random

import pytest
from pyspark.sql import functions as F

from data import ACCOUNT, change, changes, late_story_tweets, note, players, tweet, tweets, write_lines
from mentionwise.operators.dedup import drop_duplicates_stream
from mentionwise.operators.enrich import enrich, matched, mentions
from mentionwise.operators.gate import decode_control, gate, with_control
from mentionwise.operators.windows import classify, firings, late_rows, windowed_rows, with_clock
from mentionwise.plans.jobs import (
    detect_tampering_stream, final_detections_stream, mention_windows, mention_windows_sql,
    quarantine_stream,
)
from mentionwise.operators.windows import hop_rows
from mentionwise.session import freeze
from mentionwise.sinks.writers import run_available, write_batch
from mentionwise.sources.readers import stream_control, stream_json, stream_tweets, tweet_view
from mentionwise.streaming.detector import Detector, result_lines
from mentionwise.streaming.gate import gate_stream


def _random_feed(seed, n=60):
    rng = random.Random(seed)
    rows, control = [], []
    for i in range(1, n + 1):
        if rng.random() < 0.15:
            team = rng.choice(["LA Lakers", "BK Nets"])
            control.append(change(i, team, rng.random() < 0.4, rng.choice(["MODIFY", "REMOVE"])))
            continue
        src = rng.choice(["Lebron James"] * 3 + ["Anthony Davis", "Kevin Durant"])
        dst = rng.choice(["Kyrie Irving", "Stephen Curry"])
        at = max(0, i * 4 - rng.choice([0, 0, 10, 40, 90]))
        rows.append(tweet(i, at, ACCOUNT[src], [note("60", dst)]))
    return rows, control


def _cuts(rng, last, parts):
    return sorted(rng.sample(range(2, last), parts - 1)) + [last + 1]


def _run_in_parts(spark, tmp_path, rows, control, cuts, step):
    """Write the feeds up to each cut, then run ``step`` over what is new."""
    done = 0
    for n, cut in enumerate(cuts):
        write_lines(tmp_path / "tweets", f"{n}.json", [r for r in rows if done <= r["arrival"] < cut])
        write_lines(tmp_path / "control", f"{n}.json", [r for r in control if done <= r["arrival"] < cut])
        done = cut
        step(stream_tweets(spark, str(tmp_path / "tweets")), stream_control(spark, str(tmp_path / "control")))


def _key(df, *cols):
    return sorted(tuple(str(v) for v in r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("seed,clock", [(1, "global"), (2, "team")])
def test_detector_stream_equals_batch(spark, tmp_path, seed, clock):
    rows, control = _random_feed(seed)
    out = str(tmp_path / "out")

    def step(tweet_stream, control_stream):
        detector = Detector(out, str(tmp_path / "state"), 60, 30, 20, clock=clock)
        detect_tampering_stream(
            tweet_stream, control_stream, players(spark), out, str(tmp_path / "check"), detector)

    _run_in_parts(spark, tmp_path, rows, control, _cuts(random.Random(seed), 60, 3), step)

    passed = gate(matched(enrich(mentions(tweets(spark, rows)), players(spark))),
                  decode_control(changes(spark, control)))
    batch = freeze(classify(with_clock(passed, clock), 60, 30, 20), "batch")
    assert _key(spark.read.parquet(f"{out}/late"), "id") == _key(late_rows(batch), "id")

    ends = {r["clock_key"]: r["m"] for r in batch.groupBy("clock_key").agg(
        F.max(F.unix_millis("event_time")).alias("m")).collect()}
    # windows that have not fired are not archived yet
    fired = [r for r in windowed_rows(batch).collect() if r["refire"] or r["window_end"] + 20_000 <= ends[r["clock_key"]]]
    archived = spark.read.parquet(f"{out}/windowed")
    assert _key(archived, "id") == sorted((r["id"],) for r in fired)
    assert 0 < len(fired) < windowed_rows(batch).count()
    cols = ["team", "tamperingPlayer", "window_start", "revision", "total", "names"]
    want = [r for r in firings(batch, 20).collect()
            if r["revision"] > 0 or r["window_end"] + 20_000 <= ends["all" if clock == "global" else r["team"]]]
    got = spark.read.parquet(f"{out}/results")
    assert _key(got, *cols) == sorted(tuple(str(r[c]) for c in cols) for r in want)
    assert want
    assert result_lines(got).count() == len(want)


def test_detector_replay_changes_nothing(spark, tmp_path):
    rows = matched(enrich(mentions(tweets(spark, late_story_tweets())), players(spark)))
    control = decode_control(changes(spark, [change(100, "Dallas", True, arrival=0)]))
    mixed = with_control(rows, control)
    first, second = (freeze(mixed.where(c), "part") for c in ("arrival <= 3", "arrival > 3"))
    detector = Detector(str(tmp_path / "out"), str(tmp_path / "state"))
    detector(first, 0)
    detector(second, 1)
    cols = ["window_start", "revision", "total"]
    before = _key(spark.read.parquet(f"{tmp_path}/out/results"), *cols)
    detector(second, 1)
    assert _key(spark.read.parquet(f"{tmp_path}/out/results"), *cols) == before
    assert before == sorted([("0", "0", "2"), ("0", "1", "3"), ("60000", "0", "2")])
    assert _key(spark.read.parquet(f"{tmp_path}/out/late"), "id") == [("6",)]


def test_gate_stream_equals_batch(spark, tmp_path):
    rows, control = _random_feed(7)
    out = str(tmp_path / "out")

    def step(tweet_stream, control_stream):
        flat = matched(enrich(mentions(tweet_stream), players(spark), salts=3, broadcast=False))
        run_available(gate_stream(flat, decode_control(control_stream), salts=3), str(tmp_path / "check"),
                      lambda b, n: write_batch(b, out, n))

    _run_in_parts(spark, tmp_path, rows, control, _cuts(random.Random(7), 60, 2), step)
    passed = gate(matched(enrich(mentions(tweets(spark, rows)), players(spark))),
                  decode_control(changes(spark, control)))
    got = _key(spark.read.parquet(out), "id", "event_time", "src_team", "dst_name")
    assert got == _key(passed, "id", "event_time", "src_team", "dst_name")
    assert 0 < len(got) < len(rows)


def _append(df, tmp_path, name="out"):
    (df.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"{name}-check"))
     .trigger(availableNow=True).start(str(tmp_path / name)).awaitTermination())


def test_final_results_stream(spark, tmp_path):
    rows = [tweet(i, s, ACCOUNT["Lebron James"], [note("60", "Kyrie Irving")])
            for i, s in enumerate([5, 10, 70, 75, 300], 1)]

    def step(tweet_stream, _):
        flat = matched(enrich(mentions(tweet_stream), players(spark), broadcast=True))
        _append(final_detections_stream(flat, 60, 30, 20), tmp_path)

    _run_in_parts(spark, tmp_path, rows, [], [3, 6], step)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert _key(got, "window_start", "total") == [("0", "2"), ("60000", "2")]


def test_hop_stream_and_sql_view(spark, tmp_path):
    rows = [tweet(i, s, "KingJames", [note("60", "Kyrie Irving")]) for i, s in enumerate([1, 2, 60], 1)]

    def step(tweet_stream, _):
        _append(mention_windows(tweet_stream, 20, 10, 5), tmp_path, "frame")
        tweet_view(spark, hop_rows(tweet_stream), "hop_stream_view", "5 seconds")
        _append(mention_windows_sql(spark, "hop_stream_view", 20, 10), tmp_path, "sql")

    _run_in_parts(spark, tmp_path, rows, [], [3, 4], step)
    for name in ("frame", "sql"):
        got = spark.read.parquet(str(tmp_path / name)).withColumn("e", F.unix_seconds("event_time"))
        assert _key(got, "e", "total") == [("10", "2"), ("20", "2")]


def test_quarantine_and_dedup_streams(spark, tmp_path):
    rows = [tweet(1, 5, "nobody", [note("60", "Kyrie Irving")]), tweet(2, 5, "KingJames", [])]
    write_lines(tmp_path / "tweets", "a.json", rows)
    quarantine_stream(stream_tweets(spark, str(tmp_path / "tweets")), players(spark),
                      str(tmp_path / "bad"), str(tmp_path / "bad-check"))
    assert _key(spark.read.parquet(str(tmp_path / "bad")), "id", "miss") == [("1", "source"), ("2", "athlete")]

    for name, ids in (("a", ["1", "1", "2"]), ("b", ["2", "3"])):
        write_lines(tmp_path / "ids", f"{name}.json", [{"id": i, "t": 1000} for i in ids])
        source = stream_json(spark, str(tmp_path / "ids"), "id STRING, t BIGINT")
        timed = source.select("id", F.timestamp_millis("t").alias("event_time"))
        _append(drop_duplicates_stream(timed), tmp_path, "deduped")
    assert _key(spark.read.parquet(str(tmp_path / "deduped")), "id") == [("1",), ("2",), ("3",)]

"""Nothing is lost or repeated: undeclared fields, several runs, replays, runs that break off."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from data import ACCOUNT, change, note, players, tweet, write_lines
from mentionwise.operators.dedup import latest_records, whole_records
from mentionwise.operators.enrich import mentions
from mentionwise.operators.ingest import decode_payloads, with_related
from mentionwise.plans.jobs import dedupe_tweets, detect_tampering_stream, land_tweets, load_totals
from mentionwise.schemas import STREAM_TWEET
from mentionwise.session import freeze
from mentionwise.sinks import writers
from mentionwise.sinks.writers import read_version, run_available, with_arrival, write_version
from mentionwise.sources.incremental import Bookmark, read_lines, run_incremental
from mentionwise.sources.readers import stream_control, stream_json, stream_tweets
from mentionwise.streaming.detector import Detector, committed


def _lines(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))


# ---- whole records

def test_records_keep_what_nobody_declared(spark, tmp_path):
    folder = tmp_path / "raw"
    first = {"id": "1", "created_at": "2022-08-08", "public_metrics": {"like_count": 3, "by": [1, {"x": None}]}}
    later = first | {"created_at": "2022-08-09", "new": 1.50}
    _lines(folder / "year=2022" / "month=08" / "day=08", "a.json", [first, later, "broken {", '["list"]', {"id": 5}, {"text": "no id"}])
    _lines(folder / "year=2022" / "month=08" / "day=09", "a.json", [first, {"id": "2", "odd key.": {"é": [[]]}}])
    broken = str(tmp_path / "broken")
    dedupe_tweets(spark, str(folder), str(tmp_path / "out"), "whole_tweets", broken=broken)
    got = {r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()}
    assert got == {json.dumps(x) for x in (later, {"id": 5}, {"text": "no id"}, {"id": "2", "odd key.": {"é": [[]]}})}
    assert {r["value"] for r in spark.read.text(broken).collect()} == {"broken {", '["list"]'}
    assert spark.table("whole_tweets").where("id = '1'").first()["created_at"] == "2022-08-09"


def test_date_from_folder_or_record(spark):
    rows = [('{"id":"1","year":"2020","month":"01","day":"02"}', "2022"), ('{"id":"2","year":"2021"}', None)]
    told = whole_records(spark.createDataFrame(rows, "value STRING, year STRING"))
    assert {(r["id"], r["year"], r["month"]) for r in told.collect()} == {("1", "2022", "01"), ("2", "2021", None)}
    assert latest_records(told.where("false")).count() == 0


def test_a_repeated_bookmark_run_replaces_its_records(spark, tmp_path, monkeypatch):
    folder, out, check = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "check")
    day = folder / "year=2022" / "month=08" / "day=08"
    _lines(day, "a.json", [{"id": "1"}, {"id": "2"}])
    run = lambda mode: dedupe_tweets(spark, str(folder), out, "by_run", mode, check)
    run("enable")
    _lines(day, "b.json", [{"id": "3"}])
    with monkeypatch.context() as m:
        m.setattr(Bookmark, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run("enable")
    _lines(day, "c.json", [{"id": "4"}])
    run("pause")
    run("enable")
    run("enable")
    ids = [json.loads(r["value"])["id"] for r in spark.read.text(out).collect()]
    assert sorted(ids) == ["1", "2", "3", "4"]
    assert sorted(r["id"] for r in spark.table("by_run").collect()) == ["1", "2", "3", "4"]


# ---- bookmark

def test_bookmark_reads_again_what_broke_off_and_what_changed(spark, tmp_path):
    folder, check, seen = tmp_path / "in", str(tmp_path / "check"), []
    _lines(folder, "a.json", [{"id": "a"}])

    def note_rows(rows, run):
        seen.append((run, sorted(r["value"] for r in rows.collect())))
        if len(seen) == 2:
            raise RuntimeError("broken off")

    run = lambda: run_incremental(spark, str(folder), read_lines, check, note_rows, "enable")
    run()
    _lines(folder, "b.json", [{"id": "b"}])
    with pytest.raises(RuntimeError):
        run()
    run()
    run()  # nothing new: not called
    _lines(folder, "a.json", [{"id": "a2"}])
    os.utime(folder / "a.json", (2_000_000_000, 2_000_000_000))
    run()
    b = ['{"id": "b"}']
    assert seen == [(0, ['{"id": "a"}']), (1, b), (1, b), (2, ['{"id": "a2"}'])]
    with pytest.raises(ValueError):
        run_incremental(spark, str(folder), read_lines, check, note_rows, "never")


def test_old_files_of_a_stream_are_read(spark, tmp_path):
    folder = tmp_path / "in"
    _lines(folder, "new.json", [{"id": "new"}])
    _lines(folder, "old.json", [{"id": "old"}])
    os.utime(folder / "old.json", (1_000_000_000, 1_000_000_000))
    got = []
    run_available(stream_json(spark, str(folder), "id STRING", max_files=1), str(tmp_path / "check"),
                  lambda rows, _: got.extend(r["id"] for r in rows.collect()))
    assert sorted(got) == ["new", "old"]


# ---- landing

def _feed(spark, folder):
    return spark.readStream.text(str(folder)).withColumnRenamed("value", "payload")


def test_two_checkpoints_land_in_one_folder(spark, tmp_path):
    outs = [str(tmp_path / p) for p in ("tweets", "errors", "originals")]
    for n in range(2):
        main = {"data": [{"id": str(n), "created_at": "2022-08-09T01:00:00.000Z"}], "includes": {"users": []}}
        _lines(tmp_path / f"feed{n}", "a.txt", [main, f"broken {n}"])
        for _ in range(2):
            land_tweets(_feed(spark, tmp_path / f"feed{n}"), *outs, str(tmp_path / f"check{n}"), str(tmp_path / "counts"))
    assert [spark.read.text(p).count() for p in outs] == [2, 2, 4]
    counts = spark.read.parquet(str(tmp_path / "counts")).agg(F.sum("processed"), F.sum("failed")).first()
    assert tuple(counts) == (2, 2)


def test_a_replayed_batch_keeps_its_arrival(spark, tmp_path):
    _lines(tmp_path / "feed", "a.txt", ["x", "y"])
    got = []

    def note_times(batch, n):
        got.append((n, {r["arrived_at"] for r in batch.collect()}))

    run_available(with_arrival(_feed(spark, tmp_path / "feed")), str(tmp_path / "check"), note_times)
    # as if the run had ended before it could note that the batch was done
    for f in (tmp_path / "check" / "commits").iterdir():
        f.unlink()
    run_available(with_arrival(_feed(spark, tmp_path / "feed")), str(tmp_path / "check"), note_times)
    assert got[0] == got[1] and len(got[0][1]) == 1


def test_byte_order_mark_white_space_and_overflow(spark):
    main = json.dumps({"data": [{"id": "1", "created_at": "2022"}], "includes": {"users": [], "tweets": [{"id": "2", "created_at": "2023"}]}})
    feed = spark.createDataFrame([(p,) for p in ("\ufeff" + main, "\t " + main + " \n", "\ufeff \ufeff" + main)], "payload STRING")
    found = decode_payloads(with_related(feed)).collect()
    assert Counter((r["status"], r["created_at"]) for r in found) == {("Ok", "2022"): 2, ("Ok", "2023"): 2, ("ProcessingFailed", None): 1}
    rows = [tweet(i, t, "KingJames", []) for i, t in enumerate(["9" * 17, "9" * 30, "-" + "9" * 18, "1000"], 1)]
    frame = spark.createDataFrame([(json.dumps(r),) for r in rows], "v STRING").select(F.from_json("v", STREAM_TWEET).alias("r")).select("r.*")
    assert sorted(r["id"] for r in mentions(frame).where("event_time IS NULL").collect()) == ["1", "2", "3"]


# ---- warehouse versions

def test_a_load_that_breaks_off_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(ValueError):
        read_version(spark, path)
    for n in range(4):
        assert write_version(spark.range(n + 1), path) == n
    bad = spark.range(3).select(F.raise_error(F.lit("stop")).cast("int").alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_version(bad, path)
    assert read_version(spark, path).count() == 4
    assert sorted(p.name for p in (tmp_path / "table" / "data").iterdir() if p.is_dir()) == ["2", "3", "4"]
    assert write_version(spark.range(9), path) == 4 and read_version(spark, path).count() == 9


def test_rejects_show_values_as_written(spark, tmp_path):
    rows = [{"year": "2022", "month": "8", "day": 9, "player": "A", "total": "12x"}, {"year": 2022, "month": 8, "day": 9, "player": "B", "total": 3}]
    _lines(tmp_path / "in", "a.json", rows)
    load_totals(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "bad"))
    assert [tuple(r) for r in read_version(spark, str(tmp_path / "t")).collect()] == [(2022, 8, 9, "B", 3)]
    bad = spark.read.json(str(tmp_path / "bad")).first()
    assert (bad["total"], bad["reject"]) == ("12x", "total")


# ---- detector

def _run(spark, tmp_path, parts, detector, read):
    for n, rows in enumerate(parts):
        write_lines(tmp_path / "tweets", f"{n}.json", rows)
        write_lines(tmp_path / "control", f"{n}.json", [change(900 + n, "Dallas", True, arrival=rows[0]["arrival"])])
        detect_tampering_stream(
            stream_tweets(spark, str(tmp_path / "tweets")), stream_control(spark, str(tmp_path / "control")),
            read, detector.out, str(tmp_path / "check"), detector)
        yield n


def test_a_player_added_between_batches_is_found(spark, tmp_path):
    folder = str(tmp_path / "players")
    players(spark).where("name <> 'Lebron James'").write.parquet(folder)
    parts = [[tweet(i, 5 + i, ACCOUNT["Lebron James"], [note("60", "Kyrie Irving")]) for i in ids] for ids in ((1, 2), (3, 4))]
    detector = Detector(str(tmp_path / "out"), str(tmp_path / "state"))
    for n in _run(spark, tmp_path, parts, detector, lambda: spark.read.parquet(folder)):
        if n == 0:
            players(spark).where("name = 'Lebron James'").write.mode("append").parquet(folder)
    missed = committed(spark, detector.out, "quarantine").collect()
    assert sorted((r["id"], r["miss"]) for r in missed) == [("1", "source"), ("2", "source")]
    held = spark.read.parquet(f"{detector.state_dir}/held/batch_id=1")
    assert sorted(r["id"] for r in held.collect()) == ["3", "4"] and committed(spark, detector.out, "windowed").count() == 0


def test_scratch_stays_the_same_and_unfinished_batches_show_nothing(spark, tmp_path, monkeypatch):
    parts = [
        [tweet(10 * n + i, 100 * n + i, ACCOUNT["Lebron James"], [note("60", "Kyrie Irving")], arrival=10 * n + i) for i in (1, 2)]
        for n in range(5)
    ]
    detector, sizes = Detector(str(tmp_path / "out"), str(tmp_path / "state")), []
    for _ in _run(spark, tmp_path, parts, detector, lambda: players(spark)):
        sizes.append(sum(len(list((tmp_path / "state" / k).iterdir())) for k in ("control", "clock", "open", "held")))
        assert not list((tmp_path / "state" / "slices").iterdir())
    assert sizes[1:] == [sizes[1]] * 4
    lines = committed(spark, detector.out, "result_lines")
    before = lines.count()
    assert before == committed(spark, detector.out, "results").count() > 0
    # output of a batch without its record
    spark.read.parquet(f"{detector.out}/results/batch_id=4").write.parquet(f"{detector.out}/results/batch_id=5")
    assert committed(spark, detector.out, "results").count() == before
    assert set(json.loads(lines.first()["value"])) == {"team", "tamperingPlayer", "total", "players", "window"}
    assert freeze(lines, "lines").count() == before and writers.VERSIONS_KEPT == 2

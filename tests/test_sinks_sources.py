import json

from pyspark.sql import functions as F

from data import b64
from mentionwise.operators.totals import daily_player_totals
from mentionwise.plans.jobs import dedupe_tweets, land_tweets
from mentionwise.schemas import ANNOTATIONS, TWEETS_TABLE
from mentionwise.sinks.writers import (
    Landing, fan_out, print_stream, run_available, write_batch, write_json_stream,
    write_partitioned_json,
)
from mentionwise.sources.catalog import (
    create_json_table, discover_schema, insert_totals, register_tweets, schema_drift,
)
from mentionwise.sources.incremental import Bookmark, run_incremental
from mentionwise.sources.readers import read_messages, read_table, read_tweets, stream_json

FLAT = f"id STRING, created_at STRING, context_annotations {ANNOTATIONS}, year STRING, month STRING, day STRING"


def _flat(spark, *days):
    note = [{"domain": {"id": "60"}, "entity": {"name": "A"}}]
    return spark.createDataFrame(
        [(f"{d}-{i}", f"2022-08-{d}", note, "2022", "08", d) for d in days for i in range(3)], FLAT)


def test_partitioned_write_adds_or_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    write_partitioned_json(_flat(spark, "08", "09"), path)
    write_partitioned_json(_flat(spark, "09"), path)
    read = read_tweets(spark, path)
    assert read.where("day = '09'").count() == 6 and read.where("day = '08'").count() == 3
    write_partitioned_json(_flat(spark, "09"), path, replace=True)
    read = read_tweets(spark, path)
    assert read.where("day = '09'").count() == 3 and read.where("day = '08'").count() == 3
    assert {r["month"] for r in read.select("month").collect()} == {"08"}


def test_a_hot_day_is_split_over_files(spark, tmp_path):
    rows = spark.range(4000).select(
        F.col("id").cast("string").alias("id"), F.lit("2022").alias("year"), F.lit("08").alias("month"),
        F.when(F.col("id") % 3 == 0, "01").otherwise("02").alias("day"))
    path = str(tmp_path / "out")
    write_partitioned_json(rows, path, max_records_per_file=500)
    files = list((tmp_path / "out").rglob("*.json"))
    assert len(files) >= 8 and spark.read.json(path).count() == 4000


def test_recursive_scan(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "x.json").write_text('{"id": "1", "year": "2022"}\n')
    assert read_tweets(spark, str(tmp_path), recursive=True).first()["year"] == "2022"


def _feed_lines():
    main = {
        "data": [{"id": "1", "created_at": "2022-08-09T01:00:00.000Z", "odd": 1}],
        "includes": {"users": [{"id": "u"}], "tweets": [{"id": "2", "created_at": "2022-08-08T01:00:00.000Z"}]},
    }
    return [json.dumps(main), "broken"]


def test_landing_job(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "a.txt").write_text("\n".join(_feed_lines()) + "\n")
    tweets, errors, originals, check = (str(tmp_path / p) for p in ("tweets", "errors", "originals", "check"))
    feed = spark.readStream.text(str(tmp_path / "feed")).withColumnRenamed("value", "payload")
    for _ in range(2):  # the second run finds nothing new
        land_tweets(feed, tweets, errors, originals, check)
    landed = {(r["id"], r["day"]) for r in read_tweets(spark, tweets).collect()}
    assert landed == {("1", "09"), ("2", "08")}
    assert '"odd":1' in spark.read.text(tweets).where("day = '09'").first()["value"]
    failed = spark.read.text(errors).first()
    assert failed["value"] == "broken" and failed["error"] == "json"
    assert spark.read.text(originals).count() == 3
    assert list((tmp_path / "originals").rglob("*.gz"))
    assert read_messages(spark, str(tmp_path / "feed")).count() == 2


def test_a_replayed_batch_lands_once(spark, tmp_path):
    records = spark.createDataFrame(
        [("1", b64(_feed_lines()[0])), ("2", "!!"), ("3", b64('{"id":"9","created_at":"2022-08-09"}'))],
        "recordId STRING, data STRING")
    landing = Landing(str(tmp_path / "t"), str(tmp_path / "e"), str(tmp_path / "o"))
    for batch_id in (0, 0, 1):
        landing(records, batch_id)
    assert spark.read.text(str(tmp_path / "t")).count() == 4
    assert spark.read.text(str(tmp_path / "e")).count() == 2
    assert spark.read.text(str(tmp_path / "o")).count() == 6


def test_fan_out(spark, tmp_path):
    write = fan_out(
        lambda b, n: write_batch(b, str(tmp_path / "all"), n),
        lambda b, n: write_batch(b.where("id > 1"), str(tmp_path / "some"), n))
    for _ in range(2):
        write(spark.range(4), 0)
    assert spark.read.parquet(str(tmp_path / "all")).count() == 4
    assert spark.read.parquet(str(tmp_path / "some")).count() == 2


def test_json_and_console_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id": "1"}\n{"id": "2"}\n')
    rows = stream_json(spark, str(tmp_path / "in"), "id STRING", max_files=1)
    write_json_stream(rows, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    lines = {r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()}
    assert lines == {'{"id":"1"}', '{"id":"2"}'}
    print_stream(rows).awaitTermination()


def test_dedupe_job_registers_the_table(spark, tmp_path):
    raw, clean = str(tmp_path / "raw"), str(tmp_path / "clean")
    write_partitioned_json(_flat(spark, "08", "09").union(_flat(spark, "09")), raw)
    dedupe_tweets(spark, raw, clean, "clean_tweets")
    assert read_table(spark, "clean_tweets").count() == 6
    totals = daily_player_totals(spark.table("clean_tweets"), "2022", "08", "09")
    assert totals.first()["total"] == 3
    assert spark.sql("SHOW PARTITIONS clean_tweets").count() == 2


def test_registration_adds_folders_and_reports_drift(spark, tmp_path):
    path = str(tmp_path / "tweets")
    write_partitioned_json(_flat(spark, "08"), path)
    register_tweets(spark, "drifting", path, FLAT)
    write_partitioned_json(_flat(spark, "09").withColumn("extra", F.lit(1)).drop("created_at"), path)
    register_tweets(spark, "drifting", path, FLAT)
    assert spark.table("drifting").count() == 6 and "extra" not in spark.table("drifting").columns
    write_partitioned_json(_flat(spark, "10").withColumn("id", F.lit(5)), str(tmp_path / "other"))
    stored = spark.table("drifting").schema
    drift = schema_drift(spark, stored, discover_schema(spark, path)).collect()
    assert {(r["column"], r["change"]) for r in drift if r["change"] == "added"} == {("extra", "added")}
    other = schema_drift(spark, stored, discover_schema(spark, str(tmp_path / "other"))).collect()
    assert ("id", "bigint", "type") in {(r["column"], r["found"], r["change"]) for r in other}


def test_replacing_days_of_a_partitioned_table(spark, tmp_path):
    schema = "year STRING, month STRING, day STRING, player STRING, total INT"
    create_json_table(spark, "totals_by_day", str(tmp_path / "t"), schema, ["year", "month", "day"])
    for days in (("08", "09"), ("09",)):
        insert_totals(daily_player_totals(_flat(spark, *days)), "totals_by_day", replace_days=True)
    assert spark.table("totals_by_day").count() == 2


def test_bookmark_modes(spark, tmp_path):
    path, check = str(tmp_path / "in"), str(tmp_path / "check")
    seen = []

    def note(rows, _):
        seen.append(rows.count())

    def run(mode):
        run_incremental(spark, path, TWEETS_TABLE, check, note, mode)
        return seen[-1]

    write_partitioned_json(_flat(spark, "08"), path)
    assert Bookmark(spark, check).read().count() == 0
    assert run("pause") == 3
    assert run("enable") == 3
    write_partitioned_json(_flat(spark, "09", "10"), path)
    assert run("pause") == 6
    assert run("pause") == 6
    assert run("disable") == 9
    assert run("enable") == 6
    assert run("pause") == 0


def test_run_available_resumes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    got = []
    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}.json").write_text('{"id": "%s"}\n' % name)
        run_available(stream_json(spark, str(tmp_path / "in"), "id STRING"), str(tmp_path / "c"),
                      lambda rows, _: got.extend(r["id"] for r in rows.collect()))
    assert got == ["a", "b"]

import pytest
from pyspark.sql import functions as F

from mentionwise.operators.dedup import drop_duplicates, latest_per_key
from mentionwise.operators.totals import daily_player_totals
from mentionwise.operators.typed_load import check_totals, loadable, rejects, require_all
from mentionwise.plans.jobs import load_totals, store_daily_totals
from mentionwise.sinks.writers import read_version
from mentionwise.schemas import ANNOTATIONS, TOTALS


def _tweets(spark):
    def notes(*pairs):
        return [{"domain": {"id": d}, "entity": {"name": n}} for d, n in pairs]

    rows = [
        ("1", "2022", "08", "09", notes(("60", "A"), ("60", "A"), ("3", "X"))),
        ("2", "2022", "08", "09", notes(("60", "B"))),
        ("3", "2022", "08", "09", None),
        ("4", "2022", "08", "10", notes(("60", "A"))),
        ("5", "2022", "08", "09", []),
    ]
    return spark.createDataFrame(
        rows, f"id STRING, year STRING, month STRING, day STRING, context_annotations {ANNOTATIONS}")


def test_annotations_are_counted_per_day(spark):
    day = daily_player_totals(_tweets(spark), "2022", "08", "09")
    assert {(r["player"], r["total"]) for r in day.collect()} == {("A", 2), ("B", 1)}
    assert daily_player_totals(_tweets(spark)).count() == 3


def test_null_player_is_a_group(spark):
    row = [("1", "2022", "08", "09", [{"domain": {"id": "60"}, "entity": {"name": None}}])]
    df = spark.createDataFrame(row, _tweets(spark).schema)
    assert daily_player_totals(df).first()["player"] is None


def test_the_day_is_a_value_not_a_condition(spark):
    day = daily_player_totals(_tweets(spark), "2022", "08", "09")
    assert {(r["player"], r["total"]) for r in day.collect()} == {("A", 2), ("B", 1)}
    assert daily_player_totals(_tweets(spark), "2022' OR '1'='1", "08", "09").count() == 0


def test_day_filter_reaches_the_partitions(spark, tmp_path):
    path = str(tmp_path / "tweets")
    _tweets(spark).write.partitionBy("year", "month", "day").json(path)
    table = spark.read.schema(_tweets(spark).schema).json(path)
    plan = daily_player_totals(table, "2022", "08", "09")._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "(day" in line.split("PartitionFilters")[1].split("]")[0]


def test_storing_a_day_twice_appends_twice(spark, tmp_path):
    _tweets(spark).createOrReplaceTempView("tweets_view")
    for _ in range(2):
        store_daily_totals(spark, "tweets_view", "stored_totals", str(tmp_path / "t"), "2022", "08", "09")
    table = spark.table("stored_totals")
    assert table.count() == 4
    assert table.schema.simpleString() == spark.createDataFrame([], TOTALS).schema.simpleString()


def test_dedup_by_id(spark):
    df = spark.createDataFrame(
        [("1", "b", "x"), ("1", "c", "y"), ("1", "c", "z"), ("2", "a", "x"), (None, "a", "p"), (None, "b", "q")],
        "id STRING, created_at STRING, text STRING")
    assert drop_duplicates(df).count() == 3
    kept = latest_per_key(df)
    assert {tuple(r) for r in kept.collect()} == {("1", "c", "z"), ("2", "a", "x"), (None, "b", "q")}
    assert latest_per_key(kept).exceptAll(kept).count() == 0


def test_dedup_reduces_a_hot_id_before_the_shuffle(spark):
    hot = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").cast("string").alias("created_at"))
    deduped = latest_per_key(hot)
    assert deduped.count() == 20_001
    plan = deduped._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def _raw_totals(spark):
    return spark.createDataFrame(
        [("2022", "08", "09", "A", 3), ("x", "08", "09", "A", 3), ("2022", "08", "09", None, 1),
         ("2022", "08", "09", "é" * 128, 1), ("2022", "08", "09", "e" * 255, 1), ("2022", "08", "09", "B", None)],
        TOTALS)


def test_typed_load(spark):
    checked = check_totals(_raw_totals(spark))
    good = {tuple(r) for r in loadable(checked).collect()}
    assert good == {(2022, 8, 9, "A", 3), (2022, 8, 9, "e" * 255, 1)}
    assert sorted(r["reject"] for r in rejects(checked).collect()) == ["player", "player", "total", "year"]


def test_strict_load_stops(spark):
    with pytest.raises(Exception, match="constraint broken"):
        require_all(check_totals(_raw_totals(spark))).collect()


def test_load_replaces_the_table(spark, tmp_path):
    source, target, bad = (str(tmp_path / p) for p in ("totals", "table", "bad"))
    _raw_totals(spark).write.json(source)
    for _ in range(2):
        load_totals(spark, source, target, bad)
    assert read_version(spark, target).count() == 2
    assert spark.read.json(bad).count() == 4

import json

from pyspark.sql import functions as F

from data import b64
from mentionwise.functions.columns import date_parts, event_timestamp
from mentionwise.operators.ingest import (
    decode_detections, decode_payloads, decode_records, encode_records, flat_json, good_tweets,
    match_rules, observe_quality, status_counts, with_related,
)

MAIN = {
    "data": [{"id": "1", "text": "a", "created_at": "2022-08-09T10:11:12.000Z", "odd": {"x": [1]}}],
    "includes": {"users": [{"id": "u1", "username": "KingJames"}]},
}
RELATED = {"id": "2", "text": "b", "created_at": "2022-08-10T00:00:00.000Z"}

RECORDS = {
    "main": b64(json.dumps(MAIN)),
    "related": b64(json.dumps(RELATED)),
    "not base64": "%%%",
    "not json": b64("{'single': 'quotes'}"),
    "no created_at": b64(json.dumps({"id": "3"})),
    "empty data": b64(json.dumps({"data": [], "includes": {"users": []}})),
    "no includes": b64(json.dumps({"data": MAIN["data"]})),
    "short date": b64(json.dumps({"id": "4", "created_at": "20"})),
    "data null": b64(json.dumps({"data": None})),
    "number date": b64(json.dumps({"id": "5", "created_at": 5})),
    "array": b64("[1]"),
    "trailing": b64(json.dumps(RELATED) + " x"),
    "invalid utf8": "////",
    "no padding": b64(json.dumps(RELATED) + "  ").rstrip("="),
    "null users": b64(json.dumps({"data": MAIN["data"], "includes": {"users": None}})),
    "repeated key": b64('{"id": "6", "created_at": "1999-01-01", "created_at": "2000-02-03"}'),
}


def _records(spark):
    return spark.createDataFrame(list(RECORDS.items()), "recordId STRING, data STRING")


def test_every_record_gets_a_status(spark):
    rows = {r["recordId"]: r for r in decode_records(_records(spark)).drop("tweet", "users").collect()}
    ok = {k for k, r in rows.items() if r["status"] == "Ok"}
    expected = {"main", "related", "short date", "null users", "repeated key"}
    if len(RECORDS["no padding"]) % 4 == 0:
        expected.add("no padding")
    assert ok == expected
    assert all(r["status"] == "ProcessingFailed" for k, r in rows.items() if k not in ok)
    assert (rows["main"]["year"], rows["main"]["month"], rows["main"]["day"]) == ("2022", "08", "09")
    short = rows["short date"]
    assert (short["year"], short["month"], short["day"]) == ("20", "", "")
    assert rows["repeated key"]["created_at"] == "2000-02-03"
    assert rows["invalid utf8"]["error_type"] == "encoding"
    assert rows["not base64"]["error_type"] == "json"  # nothing but stray characters: empty text
    assert rows["data null"]["error_type"] == "data"
    assert rows["no includes"]["error_type"] == "users"


def test_stray_characters_in_base64_are_skipped(spark):
    broken = RECORDS["related"][:10] + "\n" + RECORDS["related"][10:] + "\r\n"
    df = spark.createDataFrame([("x", broken)], "recordId STRING, data STRING")
    assert decode_records(df).first()["status"] == "Ok"


def test_unknown_fields_survive_and_failures_are_untouched(spark):
    out = {r["recordId"]: r for r in encode_records(decode_records(_records(spark))).collect()}
    import base64
    main = json.loads(base64.b64decode(out["main"]["data"]))
    assert main["odd"] == {"x": [1]}
    assert main["users"] == MAIN["includes"]["users"]
    assert (main["year"], main["month"], main["day"]) == ("2022", "08", "09")
    related = json.loads(base64.b64decode(out["related"]["data"]))
    assert "users" not in related and related["text"] == "b"
    for name in ("not base64", "not json", "empty data", "number date"):
        assert out[name]["data"] == RECORDS[name] and out[name]["result"] == "ProcessingFailed"


def test_encoding_is_one_line(spark):
    long = b64(json.dumps({**RELATED, "text": "é" * 5000}))
    df = spark.createDataFrame([("x", long)], "recordId STRING, data STRING")
    assert "\n" not in encode_records(decode_records(df)).first()["data"]


def test_typed_tweets(spark):
    rows = {r["recordId"]: r for r in good_tweets(decode_records(_records(spark))).collect()}
    assert rows["main"]["users"][0]["username"] == "KingJames"
    assert rows["related"]["users"] is None and rows["related"]["month"] == "08"


def test_counts_add_up(spark):
    counts = status_counts(decode_records(_records(spark))).collect()
    assert sum(r["records"] for r in counts) == len(RECORDS)


def test_quality_is_observed(spark):
    from pyspark.sql import Observation

    seen = Observation("quality")
    decoded = decode_records(_records(spark))
    failed = F.count_if(F.col("status") != "Ok")
    decoded.observe(seen, failed.alias("failed")).write.format("noop").mode("overwrite").save()
    observe_quality(decoded).write.format("noop").mode("overwrite").save()
    assert seen.get["failed"] == decoded.where("status <> 'Ok'").count()


def test_json_is_parsed_once_per_stage(spark):
    plan = decode_records(_records(spark)).where("status = 'Ok'")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("parse_json") + text.count("parseJson") <= 1


def test_related_records(spark):
    message = {**MAIN, "includes": {**MAIN["includes"], "tweets": [RELATED, {**RELATED, "id": "9"}]}}
    feed = spark.createDataFrame([(json.dumps(message),), ("broken",)], "payload STRING")
    rows = with_related(feed).collect()
    assert len(rows) == 4
    good = flat_json(decode_payloads(with_related(feed))).where("status = 'Ok'")
    ids = sorted(json.loads(r["flat"])["id"] for r in good.collect())
    assert ids == ["1", "2", "9"]


def test_event_time_forms(spark):
    df = spark.createDataFrame(
        [("1660040000123", None), ("2022-08-09T10:13:20.123Z", None), (None, "2022-08-09T10:13:20.123Z"),
         ("soon", None)], "t STRING, c STRING")
    out = [r[0] for r in df.select(
        F.unix_millis(event_timestamp(F.col("t"), F.col("c")))).collect()]
    assert out == [1660040000123, 1660040000123, 1660040000123, None]


def test_date_parts_are_slices(spark):
    df = spark.createDataFrame([("2022-13-99",), ("",)], "c STRING").withColumns(
        date_parts(F.col("c")))
    assert [tuple(r)[1:] for r in df.collect()] == [("2022", "13", "99"), ("", "", "")]


def test_keyword_rule(spark):
    texts = [("NBA finals",), ("the #nba",), ("wnba",), (None,), ("n.b.a",)]
    df = spark.createDataFrame(texts, "text STRING")
    found = match_rules(df, rules=[("nba", "nba tweets"), ("finals", "final")]).collect()
    assert {(r["text"], tuple(r["tags"])) for r in found} == {
        ("NBA finals", ("nba tweets", "final")), ("the #nba", ("nba tweets",))}


def test_detection_payload(spark):
    text = json.dumps({"team": "A", "tamperingPlayer": "B", "total": 2, "players": "[C]", "window": "w"})
    df = spark.createDataFrame([(b64(text),)], "data STRING")
    assert tuple(decode_detections(df).first()) == ("A", "B", 2, "[C]", "w")

"""Small frames in the shape of the records the jobs read."""

from __future__ import annotations

import json
from base64 import b64encode

from pyspark.sql import functions as F

from mentionwise.schemas import CONTROL_CHANGE, PLAYERS, STREAM_TWEET

PLAYER_ROWS = [
    ("luka7doncic", "Luka Doncic", "Dallas"),
    ("AntDavis23", "Anthony Davis", "LA Lakers"),
    ("KingJames", "Lebron James", "LA Lakers"),
    ("KDTrey5", "Kevin Durant", "BK Nets"),
    ("KyrieIrving", "Kyrie Irving", "BK Nets"),
    ("StephenCurry30", "Stephen Curry", "GS Warriors"),
]
ACCOUNT = {name: account for account, name, _ in PLAYER_ROWS}

MENTION = (
    "id STRING, arrival BIGINT, event_time TIMESTAMP, src_account STRING, src_name STRING, "
    "src_team STRING, dst_account STRING, dst_name STRING, dst_team STRING"
)


def b64(text: str) -> str:
    return b64encode(text.encode()).decode()


def players(spark, rows=None):
    return spark.createDataFrame(rows or PLAYER_ROWS, PLAYERS)


def note(domain, name):
    return {"domain": {"id": domain}, "entity": {"name": name}}


def tweet(tid, seconds, account, notes, arrival=None):
    """A stream tweet; ``seconds`` may be a number (epoch) or text."""
    at = str(int(seconds * 1000)) if isinstance(seconds, (int, float)) else seconds
    return {
        "event_time": at, "arrival": arrival if arrival is not None else int(tid),
        "data": [{"id": str(tid), "context_annotations": notes}],
        "includes": {"users": [{"username": account}] if account else []},
    }


def change(cid, team, allowed, event="MODIFY", arrival=None):
    image = {"team": {"S": team}, "control": {"BOOL": allowed}}
    key = "OldImage" if event == "REMOVE" else "NewImage"
    return {
        "eventName": event, "eventID": str(cid),
        "arrival": arrival if arrival is not None else int(cid), "dynamodb": {key: image},
    }


def _frame(spark, rows, schema):
    lines = spark.createDataFrame([(json.dumps(r),) for r in rows], "value STRING")
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def tweets(spark, rows):
    return _frame(spark, rows, STREAM_TWEET)


def changes(spark, rows):
    return _frame(spark, rows, CONTROL_CHANGE)


def write_lines(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


# event seconds and source names of the late-data walk-through, in arrival order;
# all mention Kyrie Irving
LATE_STORY = [
    (5, "Lebron James"), (10, "Anthony Davis"), (100, "Lebron James"), (20, "Lebron James"),
    (110, "Anthony Davis"), (30, "Lebron James"), (200, "Lebron James"),
]


def late_story_tweets():
    return [
        tweet(i, s, ACCOUNT[name], [note("60", "Kyrie Irving")])
        for i, (s, name) in enumerate(LATE_STORY, 1)
    ]

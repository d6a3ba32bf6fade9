"""Record shapes (Spark DDL) and the fixed values the results depend on."""

# ---- fixed values -----------------------------------------------------------
ATHLETE_DOMAIN = "60"
STATUS_OK = "Ok"
STATUS_FAILED = "ProcessingFailed"
NOTIFICATION_SUBJECT = "NBA Tampering Detect"
FEED_RULE = ("nba", "nba tweets")
WAREHOUSE_TEXT_BYTES = 255
DATE_PARTS = ["year", "month", "day"]

# deployed stream timings, in seconds
WINDOW_SECONDS = 60
LATENESS_SECONDS = 30
DELAY_SECONDS = 20
HOP_SIZE_SECONDS = 20
HOP_SLIDE_SECONDS = 10
HOP_DELAY_SECONDS = 5
HOP_THRESHOLD = 1
# ---- end of fixed values ----------------------------------------------------

LABEL = "STRUCT<id: STRING, name: STRING, description: STRING>"
ANNOTATIONS = f"ARRAY<STRUCT<domain: {LABEL}, entity: {LABEL}>>"

USER_FIELDS = (
    "id STRING, name STRING, username STRING, location STRING, description STRING, entities STRING"
)
USER = "STRUCT<" + ", ".join(f.replace(" ", ": ", 1) for f in USER_FIELDS.split(", ")) + ">"

TWEET_FIELDS = (
    "id STRING, text STRING, created_at STRING, author_id STRING, conversation_id STRING, "
    "in_reply_to_user_id STRING, lang STRING, possibly_sensitive BOOLEAN, source STRING, "
    f"context_annotations {ANNOTATIONS}, "
    "referenced_tweets ARRAY<STRUCT<type: STRING, id: STRING>>, entities STRING, geo STRING"
)

# place fields the feed asks for next to a tweet
PLACE_FIELDS = (
    "id STRING, name STRING, full_name STRING, country STRING, country_code STRING, "
    "place_type STRING, geo STRING"
)

FLAT_TWEET = f"{TWEET_FIELDS}, users ARRAY<{USER}>"
TWEETS_TABLE = f"{FLAT_TWEET}, year STRING, month STRING, day STRING"

ENVELOPE_RECORD = "recordId STRING, data STRING"

# `arrival` is the position the stream gave the record: it orders records of both streams
STREAM_TWEET = (
    "event_time STRING, arrival BIGINT, "
    "data ARRAY<STRUCT<id: STRING, text: STRING, created_at: STRING, "
    f"context_annotations: {ANNOTATIONS}>>, "
    "includes STRUCT<users: ARRAY<STRUCT<username: STRING>>>"
)

CONTROL_IMAGE = "STRUCT<team: STRUCT<S: STRING>, control: STRUCT<BOOL: BOOLEAN>>"
CONTROL_CHANGE = (
    "eventName STRING, eventID STRING, arrival BIGINT, "
    f"dynamodb STRUCT<NewImage: {CONTROL_IMAGE}, OldImage: {CONTROL_IMAGE}>"
)

PLAYERS = "account STRING, name STRING, team STRING"
TOTALS = "year STRING, month STRING, day STRING, player STRING, total INT"
# totals on their way into the warehouse: as written, whatever their type should be
RAW_TOTALS = "year STRING, month STRING, day STRING, player STRING, total STRING"
WAREHOUSE = "year INT, month INT, day INT, player STRING, total INT"
HOP_COUNTS = "event_time TIMESTAMP, sourceplayer STRING, destinationplayer STRING, total BIGINT"
DETECTION = "team STRING, tamperingPlayer STRING, total INT, players STRING, window STRING"

"""DuckDB SQL for every query, over the same tables and with the same column names."""

from __future__ import annotations

from mentionwise.plans.catalogue import RULES, T, TOTALS_DAY
from mentionwise.plans.workload import MAX_LAG_SECONDS

_MS = 1000
_WINDOW, _LATENESS, _DELAY = T.window * _MS, T.lateness * _MS, T.delay * _MS
_STREAM_DELAY = T.stream_delay * _MS


def _name(key: str) -> str:
    return f"'Customer#' || lpad(CAST({key} AS VARCHAR), 9, '0')"


EVENTS = f"""
ev AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS id, ts, epoch_us(ts) // 1000 AS event_ms,
         epoch_us(ts) // 1000 + (event_id * 7919 % {MAX_LAG_SECONDS}) * 1000 AS arrival,
         user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
)"""

PLAYERS = """
players AS (
  SELECT CAST(c_custkey AS VARCHAR) AS account, c_name AS name, r_name AS team
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
byname AS (
  SELECT name, account, team FROM players
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY account) = 1
)"""

TWEETS = f"""
tw AS (
  SELECT event_id, ts, id, arrival, CASE WHEN event_id % 40 <> 13 THEN event_ms END AS event_ms, k,
         CASE WHEN event_id % 40 = 7 THEN 'ghost-' || user_id ELSE CAST(user_id AS VARCHAR) END AS account,
         CASE WHEN event_id % 40 = 11 THEN NULL WHEN event_id % 40 = 9 THEN 'Nobody#' || k
              ELSE {_name('k % 20')} END AS athlete,
         CASE WHEN event_id % 40 <> 11 THEN {_name('(k * 7 + 3) % 100')} END AS athlete2
  FROM ev WHERE event_type NOT IN ('signup', 'error')
)"""

ENRICHED = """
enr AS (
  SELECT tw.id, arrival, event_ms, tw.account AS src_account, s.name AS src_name, s.team AS src_team,
         d.account AS dst_account, athlete AS dst_name, d.team AS dst_team,
         CASE WHEN event_ms IS NULL THEN 'event_time' WHEN s.account IS NULL THEN 'source' WHEN athlete IS NULL THEN 'athlete'
              WHEN d.account IS NULL THEN 'destination' END AS miss
  FROM tw LEFT JOIN players s ON tw.account = s.account LEFT JOIN byname d ON athlete = d.name
),
ok AS (SELECT * EXCLUDE (miss) FROM enr WHERE miss IS NULL)"""

CONTROL = """
ctl AS (
  SELECT team, event_type = 'signup' AS allowed, arrival, id
  FROM ev JOIN players ON CAST(user_id AS VARCHAR) = account
  WHERE event_type IN ('signup', 'error')
),
mixed AS (
  SELECT *, 1 AS kind, NULL::BOOLEAN AS control FROM ok
  UNION ALL BY NAME
  SELECT team AS src_team, arrival, id, 0 AS kind, allowed AS control FROM ctl
),
state AS (
  SELECT * EXCLUDE (control), coalesce(last_value(control IGNORE NULLS) OVER (
    PARTITION BY src_team ORDER BY arrival, kind, id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS allowed
  FROM mixed
),
passed AS (SELECT * EXCLUDE (kind, allowed) FROM state WHERE kind = 1 AND NOT allowed)"""


def _classified(by: str = "") -> str:
    return f"""
clocked AS (
  SELECT *, max(event_ms) OVER ({by} ORDER BY arrival, id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clock,
         event_ms - event_ms % {_WINDOW} AS window_start,
         event_ms - event_ms % {_WINDOW} + {_WINDOW} AS window_end
  FROM passed
),
cls AS (
  SELECT *, coalesce(window_end + {_LATENESS + _DELAY} <= clock, FALSE) AS late,
         coalesce(window_end + {_DELAY} <= clock, FALSE)
         AND NOT coalesce(window_end + {_LATENESS + _DELAY} <= clock, FALSE) AS refire
  FROM clocked
)"""


MENTION_COLUMNS = (
    "id, arrival, event_ms, src_account, src_name, src_team, dst_account, dst_name, dst_team"
)


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_UP_TO_MENTIONS = (EVENTS, PLAYERS, TWEETS, ENRICHED)
_UP_TO_GATE = (*_UP_TO_MENTIONS, CONTROL)
_GLOBAL = (*_UP_TO_GATE, _classified())
_TEAM = (*_UP_TO_GATE, _classified("PARTITION BY src_team"))


def _detect(source: str, keep: str = "TRUE", closed: str = "TRUE") -> str:
    return f"""
det AS (
  SELECT src_team AS team, dst_name AS "tamperingPlayer", count(*) AS total,
         '[' || string_agg(DISTINCT src_name, ', ' ORDER BY src_name) || ']' AS players,
         window_start, window_end
  FROM (SELECT *, event_ms - event_ms % {_WINDOW} AS window_start,
               event_ms - event_ms % {_WINDOW} + {_WINDOW} AS window_end FROM ({source}))
  WHERE src_team IS DISTINCT FROM dst_team AND {keep}
  GROUP BY src_team, dst_name, window_start, window_end
  HAVING count(*) > 1 AND {closed}
)"""


_ON_TIME = f"SELECT {MENTION_COLUMNS} FROM cls WHERE NOT late"
_TEXT = """CAST(total AS BIGINT) AS total, players,
           'TimeWindow{start=' || window_start || ', end=' || window_end || '}' AS "window\""""
_MESSAGES = """
SELECT 'NBA Tampering Detect' AS subject,
       'Nba Team ' || team || ' did ' || total || ' tweets to player ' || "tamperingPlayer"
       || '. The tweets was from the following players: ' || players AS message
FROM det"""


def _revisions(fired: str) -> str:
    """First firings (``fired`` limits them) and one revision per accepted later row."""
    return f"""
x AS (SELECT * FROM cls WHERE NOT late AND src_team IS DISTINCT FROM dst_team),
fin AS (SELECT max(event_ms) AS clock_end FROM passed),
first AS (
  SELECT src_team, dst_name, window_start, window_end, count(*) AS total,
         list_sort(list_distinct(list(src_name))) AS names, 0 AS revision
  FROM x, fin WHERE NOT refire AND {fired}
  GROUP BY ALL HAVING count(*) > 0
),
base AS (
  SELECT src_team, dst_name, window_start, count(*) AS n, list_distinct(list(src_name)) AS names
  FROM x WHERE NOT refire GROUP BY ALL
),
later AS (
  SELECT r.src_team, r.dst_name, r.window_start, r.window_end,
         coalesce(b.n, 0) + r.revision AS total,
         list_sort(list_distinct(list_concat(coalesce(b.names, []), r.seen))) AS names, r.revision
  FROM (
    SELECT *, count(*) OVER w AS revision, list(src_name) OVER w AS seen FROM x WHERE refire
    WINDOW w AS (PARTITION BY src_team, dst_name, window_start ORDER BY arrival, id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  ) r LEFT JOIN base b ON r.src_team IS NOT DISTINCT FROM b.src_team
       AND r.dst_name = b.dst_name AND r.window_start = b.window_start
)
SELECT src_team AS team, dst_name AS "tamperingPlayer", CAST(total AS BIGINT) AS total,
       '[' || array_to_string(names, ', ') || ']' AS players, window_start, window_end,
       CAST(revision AS BIGINT) AS revision
FROM (SELECT * FROM first UNION ALL BY NAME SELECT * FROM later) WHERE total > 1"""


_HOPS = f"""
hop_in AS (
  SELECT account, event_ms, athlete AS player FROM tw WHERE athlete IS NOT NULL AND event_ms IS NOT NULL
  UNION ALL SELECT account, event_ms, athlete2 FROM tw WHERE athlete2 IS NOT NULL AND event_ms IS NOT NULL
),
hops AS (
  SELECT account, player,
         event_ms - event_ms % {T.hop_slide * _MS} - s * {T.hop_slide * _MS} + {T.hop_size * _MS} AS w_end
  FROM hop_in, (SELECT unnest(range({T.hop_size // T.hop_slide})) AS s)
),
hop_out AS (
  SELECT w_end AS event_time, account AS sourceplayer, player AS destinationplayer, count(*) AS total
  FROM hops GROUP BY w_end, account, player HAVING count(*) > 1
)"""

ANNOTATED = f"""
line AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, l_quantity >= 3 AS has,
         strftime(l_shipdate, '%Y') AS year, strftime(l_shipdate, '%m') AS month,
         strftime(l_shipdate, '%d') AS day,
         CASE WHEN l_returnflag = 'R' THEN {_name('l_suppkey % 20')} END AS a1,
         CASE WHEN l_linestatus = 'O' THEN {_name('l_partkey % 20')} END AS a2
  FROM lineitem
),
ann AS (
  SELECT id, year, month, day, a1 AS player FROM line WHERE has AND a1 IS NOT NULL
  UNION ALL
  SELECT id, year, month, day, a2 FROM line WHERE has AND a2 IS NOT NULL
)"""

FLAT = """
flat AS (
  SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
         unnest([athlete, athlete2]) AS player
  FROM tw WHERE athlete IS NOT NULL
)"""

REPEATED = f"""
rep AS (
  SELECT CASE WHEN event_id % 97 <> 0 THEN id END AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS created_at,
         event_type AS text, CAST(user_id AS VARCHAR) AS author_id
  FROM ev
  UNION ALL
  SELECT CASE WHEN event_id % 97 <> 0 THEN id END,
         strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S.%gZ'), event_type, CAST(user_id AS VARCHAR)
  FROM ev WHERE event_id % 5 = 0
)"""

FEED = """
spoil AS (
  SELECT *, event_id % 56 AS kind,
         CASE event_id % 56 WHEN 14 THEN '' WHEN 42 THEN ',"created_at":5'
              WHEN 49 THEN ',"created_at":"20"'
              ELSE ',"created_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') || '"' END AS created
  FROM ev
),
parts AS (
  SELECT *,
         '{"id":"' || id || '","text":"' || event_type || '"' || created
         || ',"extra":{"k":' || k || '}}' AS tweet,
         '"users":[{"id":"' || user_id || '"}]' AS users,
         event_id % 4 = 0 AS has_related
  FROM spoil
),
bare AS (
  SELECT *,
         CASE WHEN kind = 7 THEN 'not json {'
              WHEN kind = 21 THEN '{"data":[],"includes":{' || users || '}}'
              WHEN kind = 28 THEN '{"data":[' || tweet || ']}'
              WHEN kind = 35 THEN '{"data":null}'
              WHEN event_id % 3 = 1 THEN tweet
              ELSE '{"data":[' || tweet || '],"includes":{' || users
                   || CASE WHEN has_related THEN ',"tweets":[{"id":"r' || id
                      || '","text":"related","created_at":"2023-12-31T00:00:00.000Z"}]' ELSE '' END
                   || '}}' END AS payload,
         CASE WHEN kind = 7 THEN 'json' WHEN kind IN (21, 35) THEN 'data'
              WHEN kind = 28 THEN 'users' WHEN kind IN (14, 42) THEN 'created_at' END AS broken
  FROM parts
),
feed AS (
  SELECT * REPLACE (CASE kind WHEN 1 THEN chr(9) || ' ' || payload || ' ' WHEN 2 THEN chr(65279) || payload ELSE payload END AS payload)
  FROM bare
),
records AS (
  SELECT *, CASE WHEN kind = 0 THEN '%%%not base64' ELSE to_base64(encode(payload)) END AS data,
         CASE WHEN kind = 0 THEN 'encoding' ELSE broken END AS error
  FROM feed
),
dated AS (
  SELECT *, CASE WHEN kind = 49 THEN '20' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') END AS created_at,
         kind NOT IN (7, 21, 28, 35) AND event_id % 3 <> 1 AS is_main
  FROM records
)"""

_DATE = "substr(created_at, 1, 4) AS year, substr(created_at, 6, 2) AS month, substr(created_at, 9, 2) AS day"

RAW_TOTALS = f"""
raw AS (
  SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE strftime(o_orderdate, '%Y') END AS year,
         strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN repeat('é', 128)
              ELSE {_name('o_custkey')} END AS player,
         CASE WHEN o_orderkey % 19 = 0 THEN '12x' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS total
  FROM orders
),
checked AS (
  SELECT *, CASE WHEN player IS NULL OR octet_length(encode(player)) > 255 THEN 'player'
                 WHEN TRY_CAST(year AS INTEGER) IS NULL THEN 'year'
                 WHEN TRY_CAST(total AS INTEGER) IS NULL THEN 'total' END AS reject
  FROM raw
)"""

_TOTALS_SELECT = "SELECT year, month, day, player, CAST(count(*) AS INTEGER) AS total FROM ann"
_TOTALS_GROUP = "GROUP BY year, month, day, player"


def _keyword_sql() -> str:
    found = ", ".join(
        f"CASE WHEN list_contains(words, '{rule}') THEN '{tag}' END" for rule, tag in RULES
    )
    return f"""
WITH w AS (SELECT doc_id, regexp_split_to_array(lower(text), '\\W+') AS words FROM documents),
t AS (SELECT doc_id, list_sort(list_filter([{found}], lambda x: x IS NOT NULL)) AS tags FROM w)
SELECT doc_id, array_to_string(tags, ',') AS tags FROM t WHERE len(tags) > 0"""


_REVISIONS_ALL = _with(*_GLOBAL, _revisions("TRUE"))
_REVISIONS_FIRED = _with(*_GLOBAL, _revisions(f"window_end + {_DELAY} <= clock_end"))
_ENVELOPE_ROWS = _with(EVENTS, FEED)
_CLOSED_AT = f"(SELECT max(event_ms) - {_STREAM_DELAY} FROM tw)"
_FLAT_TOTALS = "SELECT year, month, day, player, CAST(count(*) AS INTEGER) AS total FROM flat"
_INCREMENTAL = f"""{_with(EVENTS, TWEETS, FLAT)}
{_FLAT_TOTALS} WHERE event_id % 2 = 1 {_TOTALS_GROUP}
UNION ALL
{_FLAT_TOTALS} WHERE event_id % 2 = 0 {_TOTALS_GROUP}"""

_FAN = """
fan AS (
  SELECT created_at, is_main FROM dated WHERE broken IS NULL
  UNION ALL
  SELECT '2023-12-31T00:00:00.000Z', FALSE FROM dated WHERE is_main AND has_related
)"""
_LANDED_DAYS = f"""{_ENVELOPE_ROWS},{_FAN},
cut AS (SELECT {_DATE}, is_main FROM fan)
SELECT nullif(year, '') AS year, nullif(month, '') AS month, nullif(day, '') AS day,
       count(*) AS tweets, count(*) FILTER (is_main) AS main_tweets
FROM cut GROUP BY 1, 2, 3"""
# the players of whom every seventh is known in the second half only
_NEW_PLAYERS = ENRICHED.replace("FROM tw ", "FROM halves tw ").replace(
    "tw.account = s.account", "tw.account = s.account AND (tw.second OR CAST(s.account AS BIGINT) % 7 <> 3)"
).replace("athlete = d.name", "athlete = d.name AND (tw.second OR CAST(d.account AS BIGINT) % 7 <> 3)")
_HALVES = """
halves AS (SELECT *, arrival > (SELECT (min(arrival) + max(arrival)) // 2 FROM tw) AS second FROM tw)"""

ORACLE: dict[str, str] = {
    "daily_totals": f"{_with(ANNOTATED)} {_TOTALS_SELECT} {_TOTALS_GROUP}",
    "daily_totals_one_day": f"""{_with(ANNOTATED)} {_TOTALS_SELECT} {_TOTALS_GROUP}
        HAVING year = '{TOTALS_DAY[0]}' AND month = '{TOTALS_DAY[1]}' AND day = '{TOTALS_DAY[2]}'""",
    "first_athlete_vs_all": f"""{_with(ANNOTATED)}
        SELECT id, CASE WHEN has THEN coalesce(a1, a2) END AS first_athlete,
               CAST(CASE WHEN has THEN (a1 IS NOT NULL)::INT + (a2 IS NOT NULL)::INT ELSE 0 END
                    AS BIGINT) AS athletes
        FROM line""",
    "dedupe_by_id": f"""{_with(EVENTS, REPEATED)} SELECT * FROM rep
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_at DESC, text DESC, author_id DESC) = 1""",
    "dedupe_ids": f"{_with(EVENTS, REPEATED)} SELECT DISTINCT id FROM rep",
    "envelope_status": f"""{_ENVELOPE_ROWS}
        SELECT CASE WHEN error IS NULL THEN 'Ok' ELSE 'ProcessingFailed' END AS status,
               coalesce(error, '') AS error_type, count(*) AS records
        FROM dated GROUP BY 1, 2""",
    "envelope_flat": f"""{_ENVELOPE_ROWS}
        SELECT id AS "recordId", id, event_type AS text, created_at,
               CASE WHEN is_main THEN CAST(user_id AS VARCHAR) END AS first_user, {_DATE}
        FROM dated WHERE error IS NULL""",
    "envelope_extra_fields": f"""{_ENVELOPE_ROWS}
        SELECT id AS "recordId", CAST(k AS BIGINT) AS k FROM dated WHERE error IS NULL""",
    "reencode_records": f"""{_ENVELOPE_ROWS}
        SELECT id AS "recordId", CASE WHEN error IS NULL THEN 'Ok' ELSE 'ProcessingFailed' END AS result,
               CASE WHEN error IS NULL THEN id END AS id,
               CASE WHEN error IS NOT NULL THEN data END AS unchanged
        FROM dated""",
    "related_fanout": f"""{_ENVELOPE_ROWS},
        fan AS (
          SELECT id AS "recordId", id, created_at FROM dated WHERE broken IS NULL
          UNION ALL
          SELECT id, 'r' || id, '2023-12-31T00:00:00.000Z' FROM dated WHERE is_main AND has_related
        )
        SELECT "recordId", id, {_DATE} FROM fan""",
    "event_time_forms": f"""{_with(EVENTS)}
        SELECT id, CASE WHEN event_id % 3 = 2 THEN epoch_us(date_trunc('day', ts)) // 1000 ELSE event_ms END AS event_ms
        FROM ev WHERE event_type NOT IN ('signup', 'error')""",
    "keyword_rule": _keyword_sql(),
    "typed_rows": f"""{_with(RAW_TOTALS)}
        SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, CAST(day AS INTEGER) AS day,
               player, TRY_CAST(total AS INTEGER) AS total FROM checked WHERE reject IS NULL""",
    "typed_rejects": f"{_with(RAW_TOTALS)} SELECT * FROM checked WHERE reject IS NOT NULL",
    "warehouse_rejects": f"{_with(RAW_TOTALS)} SELECT * FROM checked WHERE reject IS NOT NULL",
    "players_names": f"{_with(PLAYERS)} SELECT name, account, team FROM byname",
    "enrich_players": f"{_with(*_UP_TO_MENTIONS)} SELECT {MENTION_COLUMNS} FROM ok",
    "enrich_shuffled": f"{_with(*_UP_TO_MENTIONS)} SELECT {MENTION_COLUMNS} FROM ok",
    "enrich_quarantine": f"""{_with(*_UP_TO_MENTIONS)}
        SELECT id, src_account, dst_name, miss FROM enr WHERE miss IS NOT NULL""",
    "control_decode": f"""{_with(*_UP_TO_GATE)} SELECT team, allowed, arrival, id FROM ctl""",
    "control_gate": f"""{_with(*_UP_TO_GATE)}
        SELECT id, src_team, arrival, allowed FROM state WHERE kind = 1""",
    "hop_counts": f"{_with(EVENTS, TWEETS, _HOPS)} SELECT * FROM hop_out",
    "hop_counts_sql": f"{_with(EVENTS, TWEETS, _HOPS)} SELECT * FROM hop_out",
    "tumbling_tampering": f"{_with(*_UP_TO_MENTIONS, _detect('SELECT * FROM ok'))} SELECT * FROM det",
    "tampering_final": f"{_with(*_GLOBAL, _detect(_ON_TIME))} SELECT * FROM det",
    "tampering_revisions": _REVISIONS_ALL,
    "late_events": f"{_with(*_GLOBAL)} SELECT {MENTION_COLUMNS} FROM cls WHERE late",
    "late_events_team_clock": f"{_with(*_TEAM)} SELECT {MENTION_COLUMNS} FROM cls WHERE late",
    "late_event_lines": f"""{_with(*_GLOBAL)}
        SELECT src_name || ' ' || dst_name AS value, count(*) AS lines FROM cls WHERE late GROUP BY 1""",
    "windowed_events": f"{_with(*_GLOBAL)} SELECT {MENTION_COLUMNS} FROM cls WHERE NOT late",
    "windowed_events_with_refires": f"""{_with(*_GLOBAL)},
        ranked AS (
          SELECT *, CASE WHEN refire THEN row_number() OVER (
                   PARTITION BY src_team, dst_name, window_start, refire ORDER BY arrival, id) ELSE 0 END AS rk,
                 count(*) FILTER (refire) OVER (PARTITION BY src_team, dst_name, window_start) AS refires
          FROM cls WHERE NOT late
        )
        SELECT id, src_team, dst_name, window_start,
               CAST(unnest(range(1, refires + 2 - rk)) AS BIGINT) AS firing FROM ranked""",
    "detection_lines": f"""{_with(*_UP_TO_MENTIONS, _detect('SELECT * FROM ok'))}
        SELECT team, "tamperingPlayer", {_TEXT} FROM det""",
    "notify_messages": f"{_with(*_UP_TO_MENTIONS, _detect('SELECT * FROM ok'))} {_MESSAGES}",
    "notify_records": f"{_with(*_UP_TO_MENTIONS, _detect('SELECT * FROM ok'))} {_MESSAGES}",
    "landed_tweets": _LANDED_DAYS,
    "landed_two_runs": _LANDED_DAYS,
    "landed_accounting": f"""{_ENVELOPE_ROWS},{_FAN}
        SELECT (SELECT count(*) FROM fan) AS processed, (SELECT count(*) FROM dated WHERE broken IS NOT NULL) AS failed""",
    "deduped_extra_fields": f"""{_with(EVENTS)}
        SELECT id, CAST(k AS BIGINT) AS k, CAST(k * 2 AS BIGINT) AS likes, CAST(k + 1 AS BIGINT) AS second_day,
               strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
        FROM ev WHERE event_type NOT IN ('signup', 'error')""",
    "landed_errors": f"""{_ENVELOPE_ROWS}
        SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
               error, data FROM dated WHERE error IS NOT NULL""",
    "landed_originals": f"""{_ENVELOPE_ROWS}
        SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, data
        FROM dated""",
    "deduped_table": f"""{_with(EVENTS, TWEETS, FLAT)} {_FLAT_TOTALS} {_TOTALS_GROUP}""",
    "totals_table": f"""{_with(ANNOTATED)}
        {_TOTALS_SELECT} {_TOTALS_GROUP} UNION ALL {_TOTALS_SELECT} {_TOTALS_GROUP}""",
    "warehouse_load": f"""{_with(RAW_TOTALS)}
        SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, count(*) AS loaded,
               CAST(sum(TRY_CAST(total AS BIGINT)) AS BIGINT) AS total
        FROM checked WHERE reject IS NULL GROUP BY 1, 2""",
    "players_file": f"{_with(PLAYERS)} SELECT account, name, team FROM players",
    "discovered_drift": """
        SELECT * FROM (VALUES ('lang', 'string', NULL, 'missing'), ('position', NULL, 'bigint', 'added'))
        AS drift("column", stored, found, change)""",
    "incremental_totals": _INCREMENTAL,
    "bookmark_paused": _INCREMENTAL,
    "gated_windows_stream": f"""{_with(*_UP_TO_GATE)},
        middle AS (SELECT (min(arrival) + max(arrival)) // 2 AS at_ms FROM tw),
        marks AS (
          SELECT max(event_ms) FILTER (arrival <= at_ms) - {_DELAY} AS first, max(event_ms) - {_DELAY} AS last FROM ok, middle
        ),
        {_detect("SELECT passed.* FROM passed, middle, marks WHERE NOT (arrival > at_ms AND event_ms <= first)",
                 closed="window_end <= (SELECT last FROM marks)")}
        SELECT * FROM det""",
    "detector_quarantine": f"""{_with(*_UP_TO_MENTIONS)}
        SELECT id, src_account, dst_name, miss FROM enr WHERE miss IS NOT NULL""",
    "detector_result_lines": f"""SELECT team, "tamperingPlayer", {_TEXT} FROM ({_REVISIONS_FIRED})""",
    "detector_new_player": f"""{_with(EVENTS, PLAYERS, TWEETS, _HALVES, _NEW_PLAYERS)}
        SELECT id, src_account, dst_name, miss FROM enr WHERE miss IS NOT NULL""",
    "hop_stream": f"""{_with(EVENTS, TWEETS, _HOPS)}
        SELECT * FROM hop_out WHERE event_time <= {_CLOSED_AT}""",
    "tumbling_stream": f"""{_with(*_UP_TO_MENTIONS, _detect('SELECT * FROM ok',
        closed='window_end <= (SELECT max(event_ms) - ' + str(_STREAM_DELAY) + ' FROM ok)'))}
        SELECT * FROM det""",
    "control_gate_stream": f"{_with(*_UP_TO_GATE)} SELECT {MENTION_COLUMNS} FROM passed",
    "revisions_stream": _REVISIONS_FIRED,
    "late_stream": f"{_with(*_GLOBAL)} SELECT {MENTION_COLUMNS} FROM cls WHERE late",
    "windowed_stream_team_clock": f"""{_with(*_TEAM)},
        ends AS (SELECT src_team AS team, max(event_ms) AS clock_end FROM passed GROUP BY src_team)
        SELECT {MENTION_COLUMNS} FROM cls JOIN ends ON src_team = team
        WHERE NOT late AND (refire OR window_end + {_DELAY} <= clock_end)""",
    "quarantine_stream": f"""{_with(*_UP_TO_MENTIONS)}
        SELECT id, src_account, dst_name, miss FROM enr WHERE miss IS NOT NULL""",
    "dedupe_stream": f"""{_with(EVENTS)}
        SELECT id, user_id FROM ev WHERE event_type NOT IN ('signup', 'error')""",
}

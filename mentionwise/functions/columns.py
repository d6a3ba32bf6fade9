"""Column helpers. Everything here is a built-in expression; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mentionwise.schemas import ATHLETE_DOMAIN, NOTIFICATION_SUBJECT

# 31 December 9999 in epoch milliseconds
MAX_MILLIS = 253_402_300_799_999


def date_parts(created_at: Column) -> dict[str, Column]:
    """Year, month and day as text slices: a malformed date gives short parts, no error."""
    return {
        "year": F.substring(created_at, 1, 4),
        "month": F.substring(created_at, 6, 2),
        "day": F.substring(created_at, 9, 2),
    }


def event_timestamp(event_time: Column, created_at: Column | None = None) -> Column:
    """Epoch millis or ISO text to a timestamp; ``created_at`` is the fallback."""
    text = event_time.cast("string")
    millis = text.try_cast("bigint")
    # outside this range a timestamp overflows: such a record has no time and goes to quarantine
    millis = F.when(millis.between(-MAX_MILLIS, MAX_MILLIS), millis)
    parsed = [F.timestamp_millis(millis), F.try_to_timestamp(text)]
    if created_at is not None:
        parsed.append(F.try_to_timestamp(created_at))
    return F.coalesce(*parsed)


def is_athlete(annotation: Column) -> Column:
    return annotation["domain"]["id"] == ATHLETE_DOMAIN


def athletes(annotations: Column) -> Column:
    """The annotations of the athlete domain, in their order."""
    return F.filter(annotations, is_athlete)


def first_athlete(annotations: Column) -> Column:
    return F.get(athletes(annotations), F.lit(0))["entity"]["name"]


def first_username(users: Column) -> Column:
    return F.get(users, F.lit(0))["username"]


def crosses_teams(src_team: Column, dst_team: Column) -> Column:
    return ~src_team.eqNullSafe(dst_team)


def window_text(start: Column, end: Column) -> Column:
    return F.format_string(
        "TimeWindow{start=%d, end=%d}", F.unix_millis(start), F.unix_millis(end)
    )


def names_text(names: Column) -> Column:
    """A set of names printed as ``[A, B]``, sorted so that it is the same on every run."""
    return F.concat(F.lit("["), F.array_join(F.array_sort(names), ", "), F.lit("]"))


def message_text(team: Column, total: Column, player: Column, players: Column) -> Column:
    return F.concat(
        F.lit("Nba Team "), team,
        F.lit(" did "), total.cast("string"),
        F.lit(" tweets to player "), player,
        F.lit(". The tweets was from the following players: "), players,
    )


def message_subject() -> Column:
    return F.lit(NOTIFICATION_SUBJECT)

import random

import pytest
from pyspark.sql import functions as F

from data import change, changes, note, players, tweet, tweets
from mentionwise.operators import enrich as enrichment
from mentionwise.operators.enrich import (
    enrich, fits_broadcast, matched, mentions, players_by_name, quarantined, validate_players,
)
from mentionwise.operators.gate import control_state, decode_control, gate
from mentionwise.operators.running import SLICE, running, slice_by
from mentionwise.sources.readers import read_players

LEBRON, DAVIS = "KingJames", "AntDavis23"


def _mixed(spark):
    return tweets(spark, [
        tweet(1, 5, LEBRON, [note("3", "X"), note("60", "Kyrie Irving"), note("60", "Stephen Curry")]),
        tweet(2, 6, "nobody", [note("60", "Kyrie Irving")]),
        tweet(3, 7, LEBRON, [note("60", "Nobody")]),
        tweet(4, 8, LEBRON, [note("3", "X")]),
        tweet(5, 9, None, [note("60", "Kyrie Irving")]),
        tweet(6, "soon", LEBRON, [note("60", "Kyrie Irving")]),
    ])


def test_first_athlete_and_quarantine(spark):
    out = enrich(mentions(_mixed(spark)), players(spark))
    good = matched(out).collect()
    assert [(r["id"], r["dst_name"], r["dst_team"], r["src_team"]) for r in good] == [
        ("1", "Kyrie Irving", "BK Nets", "LA Lakers")]
    assert {(r["id"], r["miss"]) for r in quarantined(out).collect()} == {
        ("2", "source"), ("3", "destination"), ("4", "athlete"), ("5", "source"), ("6", "event_time")}


@pytest.mark.parametrize("salts", [1, 5])
def test_shuffled_lookup_gives_the_same(spark, salts):
    flat = mentions(_mixed(spark))
    small = enrich(flat, players(spark), broadcast=True)
    large = enrich(flat, players(spark), broadcast=False, salts=salts)
    assert small.exceptAll(large).count() == large.exceptAll(small).count() == 0


def test_broadcast_only_below_the_bound(spark, monkeypatch):
    assert fits_broadcast(players(spark))
    assert not fits_broadcast(players(spark), max_rows=5)
    assert not fits_broadcast(players(spark), max_bytes=10)
    monkeypatch.setattr(enrichment, "fits_broadcast", lambda _: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = enrich(mentions(_mixed(spark)), players(spark))._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_smallest_account_wins_a_shared_name(spark):
    rows = [("b", "Same", "T2"), ("a", "Same", "T1"), ("c", "Other", "T3")]
    assert {tuple(r) for r in players_by_name(players(spark, rows)).collect()} == {
        ("Same", "a", "T1"), ("Other", "c", "T3")}


def test_accounts_must_be_unique(spark):
    validate_players(players(spark))
    with pytest.raises(ValueError, match="not unique"):
        validate_players(players(spark, [("a", "x", "t"), ("a", "y", "t")]))


def test_players_file(spark, tmp_path):
    path = tmp_path / "players.csv"
    path.write_text("# comment\nKingJames;Lebron James;LA Lakers\nbroken line\nKyrieIrving;Kyrie Irving;Nets\n")
    assert {tuple(r) for r in read_players(spark, str(path)).collect()} == {
        ("KingJames", "Lebron James", "LA Lakers"), ("KyrieIrving", "Kyrie Irving", "Nets")}


def _passing(spark, tweet_rows, change_rows):
    rows = matched(enrich(mentions(tweets(spark, tweet_rows)), players(spark)))
    return sorted(r["id"] for r in gate(rows, decode_control(changes(spark, change_rows))).collect())


def test_gate_follows_arrival_order(spark):
    to_kyrie = [note("60", "Kyrie Irving")]
    passed = _passing(
        spark,
        [tweet(i, 5, LEBRON, to_kyrie) for i in (1, 3, 5, 8)] + [tweet(9, 5, "KDTrey5", to_kyrie)],
        [change(2, "LA Lakers", True, "INSERT"), change(4, "LA Lakers", False),
         change(6, "LA Lakers", True), change(7, "LA Lakers", None, "REMOVE")],
    )
    assert passed == ["1", "5", "8", "9"]


def test_control_comes_first_on_a_tie(spark):
    to_kyrie = [note("60", "Kyrie Irving")]
    assert _passing(spark, [tweet(1, 5, LEBRON, to_kyrie, arrival=7)],
                    [change(9, "LA Lakers", True, arrival=7)]) == []


def test_control_change_records(spark):
    out = decode_control(changes(spark, [
        change(1, "A", True, "INSERT"), change(2, "A", True, "REMOVE")]))
    assert [(r["team"], r["allowed"]) for r in out.orderBy("arrival").collect()] == [("A", True), ("A", False)]


@pytest.mark.parametrize("slices", [1, 3, 16])
def test_running_matches_a_plain_loop_with_a_hot_key(spark, slices):
    rng = random.Random(slices)
    rows = [
        # one key holds most rows, and many rows share an arrival
        (rng.choice(["hot"] * 5 + ["a", "b", None]), rng.randrange(12), i,
         rng.choice([None, True, False]), rng.randrange(1000))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "k STRING, at BIGINT, id BIGINT, flag BOOLEAN, v INT")
    outputs = {"last": ("last", F.col("flag")), "top": ("max", F.col("v")),
               "n": ("count", F.col("flag"))}

    for inclusive in (False, True):
        state, want = {}, {}
        for k, at, i, flag, v in sorted(rows, key=lambda r: (r[1], r[2])):
            before = state.get(k, (None, None, 0))
            after = (flag if flag is not None else before[0],
                     v if before[1] is None else max(before[1], v),
                     before[2] + (flag is not None))
            state[k] = after
            want[i] = after if inclusive else before
        got = running(df, ["k"], ["at", "id"], outputs, inclusive, slices).collect()
        assert len(got) == len(rows)
        assert {r["id"]: (r["last"], r["top"], r["n"]) for r in got} == want


def test_a_hot_key_covers_many_slices(spark):
    df = spark.range(0, 8000, 1, 4).select(
        F.lit("hot").alias("k"), (F.col("id") % 2).alias("at"), "id")
    sizes = [r["count"] for r in slice_by(df, ["at", "id"], 8).groupBy("k", SLICE).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 8000 / 8


def test_state_is_left_outer(spark):
    to_kyrie = [note("60", "Kyrie Irving")]
    rows = matched(enrich(mentions(tweets(spark, [tweet(1, 5, LEBRON, to_kyrie)])), players(spark)))
    state = control_state(rows, decode_control(changes(spark, [change(0, "BK Nets", True)])))
    assert state.first()["allowed"] is False

"""What a stream's replay, the detector and the gate are given is computed once, however often they use it."""

from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from mentionwise.operators.gate import control_state
from mentionwise.streaming.detector import Detector
from mentionwise.streaming.gate import _arrival_order
from mentionwise.streaming.replay import replay

MIXED = (
    "id STRING, arrival BIGINT, event_time TIMESTAMP, account STRING, athlete STRING, kind INT, "
    "src_team STRING, control BOOLEAN"
)


def _counted(spark, rows, schema):
    """The rows, and an accumulator that counts how often one of them was computed."""
    seen = spark.sparkContext.accumulator(0)

    def touch(row):
        seen.add(1)
        return row

    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 3).map(touch), schema), seen


def test_replay_derives_each_feed_once(spark, tmp_path):
    rows, seen = _counted(spark, [(str(i), i) for i in range(30)], "id STRING, arrival BIGINT")
    sizes = []
    replay({f"{tmp_path}/in": rows}, lambda: sizes.append(spark.read.json(f"{tmp_path}/in").count()))
    assert len(sizes) == 3 and sizes[-1] == 30
    assert seen.value == 30


def test_replay_keeps_rows_without_an_arrival_out_as_before(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", None), ("c", 2), ("c", 2)], "id STRING, arrival BIGINT")
    replay({f"{tmp_path}/in": rows}, lambda: None)
    found = sorted(r["id"] for r in spark.read.json(f"{tmp_path}/in").select("id").collect())
    assert found == ["a", "c", "c"]


def test_detector_computes_its_batch_once(spark, tmp_path):
    at = datetime(2024, 1, 1, 0, 0, 10)
    rows = [(f"m{i}", i, at, "1" if i % 2 else "nobody", "Two", 1, None, None) for i in range(12)]
    rows += [(f"c{i}", i, None, None, None, 0, "A", False) for i in range(4)]
    batch, seen = _counted(spark, rows, MIXED)
    players = spark.createDataFrame([("1", "One", "A"), ("2", "Two", "B")], "account STRING, name STRING, team STRING")
    out, state = f"{tmp_path}/out", f"{tmp_path}/state"
    Detector(out, state, slices=2, players=lambda: players)(batch, 0)
    assert seen.value == len(rows)
    assert spark.read.parquet(f"{out}/quarantine").count() == 6
    held = spark.read.parquet(f"{state}/held/batch_id=0").select("id").collect()
    assert sorted(r["id"] for r in held) == sorted(f"m{i}" for i in range(1, 12, 2))


def test_gate_computes_its_rows_once(spark):
    at = datetime(2024, 1, 1, 0, 0, 10)
    rows, seen = _counted(
        spark, [(f"m{i}", 2 * i, at, "A") for i in range(20)], "id STRING, arrival BIGINT, event_time TIMESTAMP, src_team STRING"
    )
    control = spark.createDataFrame([("A", 9, "c", True), ("A", 21, "d", False)], "team STRING, arrival BIGINT, id STRING, allowed BOOLEAN")
    state = control_state(rows, control, slices=3)
    allowed = sorted(int(r["id"][1:]) for r in state.where(F.col("allowed")).collect())
    assert allowed == list(range(5, 11))
    assert seen.value == 20


def test_arrival_order_is_the_one_of_three_sorted_columns():
    rng = np.random.default_rng(3)
    batch = pd.DataFrame({
        "arrival": rng.choice([1.0, 2.0, 3.0, np.nan], 200), "kind": rng.integers(0, 2, 200),
        "id": rng.choice(["10", "9", "a", None], 200),
    })
    sorted_rows = batch.sort_values(["arrival", "kind", "id"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(batch.take(_arrival_order(batch)).reset_index(drop=True), sorted_rows)

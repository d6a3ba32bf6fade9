"""Streaming control gate: one boolean of keyed state per team."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from mentionwise.operators.gate import CONTROL, TWEET

# the processor travels by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MENTION = (
    "id STRING, arrival BIGINT, event_time TIMESTAMP, src_account STRING, src_name STRING, "
    "src_team STRING, dst_account STRING, dst_name STRING, dst_team STRING"
)


def _arrival_order(batch: pd.DataFrame) -> np.ndarray:
    """Positions by (arrival, kind, id). Ids are text, so they are compared only where the rest is equal."""
    order = np.lexsort((batch["kind"].to_numpy(), batch["arrival"].to_numpy()))
    firsts = batch[["arrival", "kind"]].take(order)
    equal = firsts.duplicated(keep=False).to_numpy()
    if equal.any():
        tied = batch.take(order[equal]).sort_values(["arrival", "kind", "id"])
        order[equal] = tied.index.to_numpy()
    return order


class ControlGate(StatefulProcessor):
    """Drops the tweets of a team while its latest control value is true.

    A key's rows of one micro-batch come in no set order and are sorted by
    arrival, the control first on a tie. The state never expires.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._allowed = handle.getValueState("allowed", "allowed BOOLEAN")

    def handleInputRows(
        self, key, rows: Iterator[pd.DataFrame], timerValues
    ) -> Iterator[pd.DataFrame]:
        held = self._allowed.get() if self._allowed.exists() else None
        batch = pd.concat(list(rows), ignore_index=True)
        order = _arrival_order(batch)
        control = batch["control"].where(batch["kind"] == CONTROL).astype("boolean").loc[order]
        latest = control.ffill()
        allowed = latest.fillna(bool(held[0]) if held else False)
        if control.notna().any():
            self._allowed.update((bool(latest.iloc[-1]),))
        # the rows stay where they are, only their flags are put back in place
        passing = batch[(batch["kind"] == TWEET) & ~allowed.sort_index()]
        passing = passing.assign(event_time=pd.to_datetime(passing["event_ms"], unit="ms"))
        yield passing[[f.split()[0] for f in MENTION.split(", ")]]

    def close(self) -> None:
        pass


def gate_stream(
    mentions: DataFrame, control: DataFrame, salts: int = 8, delay: int | None = None
) -> DataFrame:
    """The tweets that pass, as a stream.

    With a ``delay`` (seconds) the stream has a watermark that goes on behind the gate,
    so that windows can follow on the same stream: tweets at or before the watermark of
    the batches before are dropped by the gate, as a window would drop them. A control
    value has no event time and is never late.

    State is keyed by (team, salt): a tweet goes to one salt, a control row to
    all of them, so a team's tweets are spread over ``salts`` tasks and each
    still meets its controls in arrival order. A key holds at most its share
    of one micro-batch, which the source's trigger limits bound.
    """
    tweets = mentions.withColumns({
        "kind": F.lit(TWEET),
        "control": F.lit(None).cast("boolean"),
        "event_ms": F.unix_millis("event_time"),
        "salt": F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"),
    })
    controls = control.select(
        F.col("team").alias("src_team"), "arrival", "id",
        F.col("allowed").alias("control"), F.lit(CONTROL).alias("kind"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
    )
    mixed = tweets.unionByName(controls, allowMissingColumns=True)
    timed = {"timeMode": "None"}
    if delay is not None:
        mixed = mixed.withWatermark("event_time", f"{delay} seconds")
        timed = {"timeMode": "EventTime", "eventTimeColumnName": "event_time"}
    return mixed.groupBy("src_team", "salt").transformWithStateInPandas(
        statefulProcessor=ControlGate(), outputStructType=MENTION, outputMode="Append", **timed
    )

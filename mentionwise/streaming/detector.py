"""Detector micro-batches: control gate, exact lateness, firings and revisions, side outputs.

Spark's own late filter uses the previous batch's watermark and only drops
rows, and keyed state would put a team's rows into one task. The detector
carries its state in small tables under ``state_dir`` instead - control values
per team, clocks, open windows - one folder per batch id, so a replayed batch
reads the same state and overwrites the same output. Each batch goes through
the batch operators, sliced by arrival.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mentionwise.operators.enrich import BROADCAST_ROWS, enrich, quarantined
from mentionwise.operators.gate import (
    ARRIVAL, CONTROL, TWEET, latest_control, passing, resolve_control,
)
from mentionwise.operators.running import SLICE, slice_by
from mentionwise.operators.windows import (
    CLOCKS, OPEN_WINDOWS, advance_clocks, classify, detection_records, firings, late_rows,
    open_windows, windowed_rows, with_clock,
)
from mentionwise.schemas import DELAY_SECONDS, LATENESS_SECONDS, WINDOW_SECONDS
from mentionwise.session import freeze, remove
from mentionwise.sinks.writers import event_lines, write_batch

CONTROLS = "src_team STRING, allowed BOOLEAN"


@dataclass
class Detector:
    """``foreachBatch`` function over mentions and control values (see ``with_control``).

    Writes ``results`` (with their revision), ``late`` and ``windowed`` tables under
    ``out``, and as text what is published: ``result_lines`` and ``late_lines``. A batch
    counts once its record is in ``commits``, which is written last; see ``committed``.
    Only the state of the batch before is ever read again, older state is removed.

    A window's rows are archived in ``windowed`` when it fires; until then they are held
    in the state. Rows that come after it has fired are archived at once.

    With ``players``, a function that reads the dimension, the mentions come as they
    are and meet the players inside the batch: the table is read, and its size
    measured, for every batch anew, so players added since the one before are found.
    Mentions that meet none go to ``quarantine``.
    """

    out: str
    state_dir: str
    window: int = WINDOW_SECONDS
    lateness: int = LATENESS_SECONDS
    delay: int = DELAY_SECONDS
    threshold: int = 1
    clock: str = "global"
    slices: int | None = None
    players: Callable[[], DataFrame] | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        controls = self._state(spark, "control", CONTROLS, batch_id)
        start = self._state(spark, "clock", CLOCKS, batch_id)
        opened = self._state(spark, "open", OPEN_WINDOWS, batch_id)

        scratch = f"{self.state_dir}/slices/batch_id={batch_id}"
        if self.players is not None:
            batch = self._met(batch, f"{scratch}/met")
        mixed = slice_by(batch, ARRIVAL, self.slices, f"{scratch}/mixed")
        if self.players is not None:
            write_batch(quarantined(mixed.where(F.col("kind") == TWEET)).drop(SLICE, "kind", "control"),
                        f"{self.out}/quarantine", batch_id)
            mixed = mixed.where(F.col("miss").isNull()).drop("miss")
        self._save(latest_control(mixed, controls), "control", batch_id)
        rows = classify(
            with_clock(passing(resolve_control(mixed, controls)), self.clock, start, path=f"{scratch}/gated"),
            self.window, self.lateness, self.delay,
        ).persist()
        try:
            self._save(advance_clocks(rows, start), "clock", batch_id)
            end = self._state(spark, "clock", CLOCKS, batch_id + 1)
            results = firings(rows, self.delay, self.threshold, opened, start, end)
            write_batch(results, f"{self.out}/results", batch_id)
            kept = rows.drop(SLICE)
            write_batch(late_rows(kept), f"{self.out}/late", batch_id)
            write_batch(self._fired(kept, end, batch_id), f"{self.out}/windowed", batch_id)
            published = spark.read.schema(results.schema).parquet(f"{self.out}/results/batch_id={batch_id}")
            self._write_lines(result_lines(published), "result_lines", batch_id)
            self._write_lines(event_lines(late_rows(kept)), "late_lines", batch_id)
            self._save(
                open_windows(rows, end, self.lateness, self.delay, opened), "open", batch_id
            )
            write_batch(
                spark.createDataFrame([(batch_id,)], "batch BIGINT").coalesce(1), f"{self.out}/commits", batch_id
            )
        finally:
            rows.unpersist()
        remove(spark, scratch)
        # a replay of this batch reads the state of the one before
        for name in ("control", "clock", "open", "held"):
            remove(spark, f"{self.state_dir}/{name}/batch_id={batch_id - 2}")

    def _fired(self, rows: DataFrame, clocks: DataFrame, batch_id: int) -> DataFrame:
        """The rows to archive now; those of windows that have not fired are held for a later batch."""
        on_time = windowed_rows(rows).drop("late")
        waiting = on_time.where(~F.col("refire"))
        earlier = self._state(rows.sparkSession, "held", waiting.schema, batch_id)
        if earlier is not None:
            waiting = waiting.unionByName(earlier)
        # one clock, or one for each team: small enough for a broadcast only if it was counted
        now = clocks.select(F.col("clock_key").alias("__key"), F.col("clock_ms").alias("__now"))
        now = F.broadcast(now) if fits_rows(now) else now
        due = waiting.join(now, waiting["clock_key"] == now["__key"], "left")
        has_fired = F.coalesce(F.col("window_end") + F.lit(self.delay * 1000) <= F.col("__now"), F.lit(False))
        marked = due.withColumn("__fired", has_fired).drop("__key", "__now")
        self._save(marked.where(~F.col("__fired")).drop("__fired"), "held", batch_id)
        return marked.where("__fired").drop("__fired").unionByName(on_time.where("refire"))

    def _met(self, batch: DataFrame, path: str) -> DataFrame:
        """Mentions with their players, or what they ``miss``, and the control values as they are.

        Spark computes a batch anew for each use, files and all: it is held for the two used here, and
        what they give is written once, as slicing reads it twice.
        """
        batch = batch.persist()
        try:
            tweets = batch.where(F.col("kind") == TWEET).select("id", "arrival", "event_time", "account", "athlete")
            met = enrich(tweets, self.players()).withColumn("kind", F.lit(TWEET))
            control = batch.where(F.col("kind") == CONTROL).select("src_team", "arrival", "id", "kind", "control")
            return freeze(met.unionByName(control, allowMissingColumns=True), "met", path)
        finally:
            batch.unpersist()

    def _write_lines(self, lines: DataFrame, name: str, batch_id: int) -> None:
        lines.write.mode("overwrite").text(f"{self.out}/{name}/batch_id={batch_id}")

    def _state(self, spark: SparkSession, name: str, schema: str | StructType, batch_id: int) -> DataFrame | None:
        """State after the batch before ``batch_id``; none before the first."""
        if batch_id == 0:
            return None
        return spark.read.schema(schema).parquet(f"{self.state_dir}/{name}/batch_id={batch_id - 1}")

    def _save(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.state_dir}/{name}/batch_id={batch_id}")


def fits_rows(df: DataFrame) -> bool:
    """Whether a table of a few bytes a row may be broadcast."""
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def committed(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Output ``name`` of the batches that were finished; one that broke off shows nothing."""
    done = spark.read.schema("batch BIGINT").option("recursiveFileLookup", "true").parquet(f"{out}/commits")
    reader = spark.read.text if name.endswith("_lines") else spark.read.parquet
    rows = reader(f"{out}/{name}")
    return rows.join(F.broadcast(done), rows["batch_id"].cast("bigint") == done["batch"]).drop("batch", "batch_id")


def result_lines(results: DataFrame) -> DataFrame:
    """Detections as the JSON text lines that are published."""
    return detection_records(results).select(F.to_json(F.struct("*")).alias("value"))

"""Collection health: attempts, commissioning runs and hours with no attempt at all."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietband import config as C
from quietband import schemas
from quietband.config import SeriesConfig
from quietband.functions import times


def clock(spark: SparkSession, now: datetime) -> DataFrame:
    """A one-row relation holding the time up to which slots are expected."""
    return spark.createDataFrame([(now.replace(tzinfo=None),)], "now timestamp_ntz")


def expected_slots(clock_row: DataFrame, series: SeriesConfig) -> DataFrame:
    """Hourly slot ids from the series start through the hour `now` lies in."""
    start = times.run_hour(F.lit(series.series_start))
    last = times.hour_of(F.col("now"))
    # sequence() refuses a backwards range, so an early clock yields no array at all.
    hours = F.when(last >= start, F.sequence(start, last, F.expr("interval 1 hour")))
    return clock_row.select(F.explode(hours).alias("hour")).select(
        times.slot_id(F.col("hour")).alias("slot")
    )


def missing_slots(slots: DataFrame, classified: DataFrame) -> DataFrame:
    """Expected slots that no eligible attempt covers."""
    covered = (
        classified.where("eligible").select(times.slot_of(F.col("run_id")).alias("slot")).distinct()
    )
    return slots.join(covered, "slot", "left_anti")


def build_run_health(classified: DataFrame, slots: DataFrame) -> DataFrame:
    """One row per attempt or commissioning run and one per missing hour."""
    attempts = classified.where(F.col("membership") != C.OUTSIDE).select(
        "run_id",
        F.when(F.col("eligible"), F.coalesce("attempt_state", F.lit(C.MALFORMED)))
        .otherwise(C.COMPLETED).alias("state"),
        "eligible",
        (F.col("eligible") & F.coalesce(F.col("attempt_state") == C.COMPLETED, F.lit(False)))
        .alias("in_trend"),
        "reason", "started_utc", "input_complete",
    )
    gaps = missing_slots(slots, classified).select(
        F.col("slot").alias("run_id"),
        F.lit(C.MISSING_SLOT).alias("state"),
        F.lit(True).alias("eligible"),
        F.lit(False).alias("in_trend"),
        F.lit(C.REASONS["missing_slot"]).alias("reason"),
        F.lit(None).cast("string").alias("started_utc"),
        F.lit(False).alias("input_complete"),
    )
    return schemas.conform(attempts.unionByName(gaps), schemas.RUN_HEALTH)


def run_health_view(health: DataFrame, run: DataFrame) -> DataFrame:
    """Health with the extraction status of each run; missing hours keep NULL."""
    return health.join(run.select("run_id", "extraction_status"), "run_id", "left").select(
        "run_id", "state", "eligible", "in_trend", "reason", "started_utc", "input_complete",
        "extraction_status",
    )


def health_totals(health: DataFrame) -> DataFrame:
    """One row of health counts.  Commissioning never counts as completed.

    ``discovered_attempts`` includes commissioning runs, ``discovered_series_attempts``
    does not; both readings are in use.
    """
    commissioning = ~F.col("eligible") & (F.col("state") == C.COMPLETED)
    missing = F.col("state") == C.MISSING_SLOT
    hour = F.when(F.col("eligible") & ~missing, times.slot_of(F.col("run_id")))
    # Collapse to (hour, state) before the global counts: one small row per hour.
    grouped = health.select(
        hour.alias("hour"), F.when(commissioning, C.COMMISSIONING).otherwise(F.col("state")).alias("kind")
    ).groupBy("hour", "kind").agg(F.count("*").alias("n"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    kind = F.col("kind")
    return grouped.agg(
        *[total(kind == s).alias(s) for s in C.ATTEMPT_STATES],
        total(kind == C.COMMISSIONING).alias(C.COMMISSIONING),
        total(kind != C.MISSING_SLOT).alias("discovered_attempts"),
        total(~kind.isin(C.MISSING_SLOT, C.COMMISSIONING)).alias("discovered_series_attempts"),
        (total(kind == C.MISSING_SLOT) + F.count_distinct("hour")).alias("expected_slots"),
    )

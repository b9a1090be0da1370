"""Run-to-run comparisons (extensions beside the core operators)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietband.operators.sweep_summary import addresses_by_band, per_frequency


def churn(observations: DataFrame, before: str, after: str) -> DataFrame:
    """Addresses of one run that the other lacks: (bssid, change)."""
    pairs = observations.where(F.col("run_id").isin(before, after))
    sides = pairs.groupBy("bssid").agg(
        F.bool_or(F.col("run_id") == before).alias("was"), F.bool_or(F.col("run_id") == after).alias("now")
    )
    return sides.where(F.col("was") != F.col("now")).select(
        "bssid", F.when(F.col("was"), "lost").otherwise("gained").alias("change")
    )


def rssi_shift(observations: DataFrame, before: str, after: str) -> DataFrame:
    """Mean-signal change of each address on each frequency heard in both runs."""
    mean = lambda r: F.avg(F.when(F.col("run_id") == r, F.col("rssi_mean_dbm")))
    both = observations.where(F.col("run_id").isin(before, after)).groupBy("bssid", "frequency_mhz").agg(
        mean(before).alias("before_dbm"), mean(after).alias("after_dbm")
    )
    return both.where(F.col("before_dbm").isNotNull() & F.col("after_dbm").isNotNull()).withColumn(
        "delta_db", F.col("after_dbm") - F.col("before_dbm")
    )


def sweep_comparison(observations: DataFrame) -> DataFrame:
    """One row per run: populated frequencies, addresses by band, beacons, weakest mean."""
    per_run = per_frequency(observations).groupBy("run_id").agg(
        F.count("*").alias("populated"), F.sum("beacons").alias("beacons"),
        F.min("weakest_mean_dbm").alias("weakest_mean_dbm"),
    )
    bands = addresses_by_band(observations).groupBy("run_id").agg(
        *[
            F.coalesce(F.max(F.when(F.col("band") == b, F.col("bssids"))), F.lit(0)).alias(name)
            for b, name in (("2.4GHz", "bssids_2_4"), ("5GHz", "bssids_5"), ("6GHz", "bssids_6"),
                            ("all", "bssids"))
        ]
    )
    return per_run.join(bands, "run_id")


def outcome_by_regime(frequencies: DataFrame, band: str = "6GHz") -> DataFrame:
    """Rows and runs per regulatory state and sample status of one band."""
    per_run = frequencies.where(F.col("band") == band).groupBy(
        "regulatory_state", "sample_status", "run_id"
    ).agg(F.count("*").alias("n"))
    return per_run.groupBy("regulatory_state", "sample_status").agg(
        F.sum("n").alias("rows"), F.count("*").alias("runs")
    )


def count_reconciliation(source: DataFrame, derived: DataFrame) -> DataFrame:
    """Runs whose row counts differ between two layers of one table."""
    left = source.groupBy("run_id").agg(F.count("*").alias("source_rows"))
    right = derived.groupBy("run_id").agg(F.count("*").alias("derived_rows"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return left.join(right, "run_id", "full_outer").select(
        "run_id", zero("source_rows"), zero("derived_rows")
    ).where(F.col("source_rows") != F.col("derived_rows"))


def tallies(rnr: DataFrame) -> DataFrame:
    """Neighbor-report rows by structure, target band and presence of identity."""
    return rnr.groupBy(
        "structure_status", "target_band",
        (F.col("tx_bssid").isNull() | F.col("frame_number").isNull()).alias("identity_missing"),
    ).agg(F.count("*").alias("rows"))

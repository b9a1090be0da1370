"""Summaries of one sweep, computed for all runs at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietband.functions import radio


def per_frequency(observations: DataFrame) -> DataFrame:
    """Populated frequencies: addresses, beacons, strongest and weakest mean signal."""
    return observations.groupBy("run_id", "band", "frequency_mhz").agg(
        F.min("channel").alias("channel"),
        F.count("*").alias("bssids"),
        F.sum("beacons").alias("beacons"),
        F.max("rssi_mean_dbm").alias("strongest_mean_dbm"),
        F.min("rssi_mean_dbm").alias("weakest_mean_dbm"),
    )


def sweep_totals(frequencies: DataFrame) -> DataFrame:
    """Manifest totals per run.  "Attempted" leaves out frequencies disabled at discovery."""
    status, skip = F.col("sample_status"), F.col("sample_status") == "regulatory_skip"
    disabled = skip & F.coalesce(F.col("error").contains("disabled"), F.lit(False))
    totals = frequencies.groupBy("run_id").agg(
        F.count("*").alias("listed"),
        F.count_if(disabled).alias("disabled"),
        F.count_if(status == "sampled").alias("populated"),
        F.count_if(status == "sampled_empty").alias("empty"),
        F.count_if(skip & ~disabled).alias("skipped"),
        F.count_if(status == "capture_error").alias("errors"),
        F.coalesce(F.sum("beacon_count"), F.lit(0)).alias("beacons"),
    )
    return totals.withColumn(
        "attempted", F.col("populated") + F.col("empty") + F.col("skipped") + F.col("errors")
    )


def addresses_by_band(observations: DataFrame) -> DataFrame:
    """Distinct addresses per run and band, and per run (``band`` = ``all``).

    A multi-band address counts in each band but once in the total.
    """
    seen = observations.groupBy("run_id", "bssid", "band").agg(F.lit(1).alias("one"))
    bands = seen.groupBy("run_id", "band").agg(F.count("bssid").alias("bssids"))
    total = observations.select("run_id", "bssid").distinct().groupBy("run_id").agg(
        F.count("bssid").alias("bssids")
    )
    return bands.unionByName(total.withColumn("band", F.lit("all")))


def sweep_verdict(totals: DataFrame) -> DataFrame:
    """A sweep is bad with any capture error, or when nothing was sampled."""
    bad = (F.col("errors") > 0) | (F.col("populated") + F.col("empty") == 0)
    return totals.select("run_id", F.when(bad, "bad").otherwise("ok").alias("verdict"))


def in_band_order(rows: DataFrame) -> DataFrame:
    """Rows ordered by run, then 2.4 < 5 < 6 GHz < other."""
    return rows.orderBy("run_id", radio.band_rank(F.col("band")), "band")

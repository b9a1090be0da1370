"""Metric views.

Facts are aggregated to run grain first and only then joined, so raw rows are shuffled once,
after map-side combining, and no side needs a broadcast hint: run-grain inputs are small and
AQE decides from their measured size.  Distinct counts are taken by a de-duplicating
aggregate on the full key, which also spreads a run that holds most of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietband import config as C
from quietband.functions import radio

_STATUS_COLUMNS = {
    "sampled": "sampled_frequencies",
    "sampled_empty": "sampled_empty_frequencies",
    "regulatory_skip": "regulatory_skips",
    "capture_error": "capture_errors",
}
_CAPABILITY_METRICS = {
    "advertises_he": "has_he",
    "advertises_he_6ghz": "has_he_6ghz",
    "advertises_eht": "has_eht",
    "advertises_mld": "has_mld",
    "advertises_multiple_bssid": "has_multiple_bssid",
    "carries_rnr": "has_rnr",
    "carries_bss_load": "has_bss_load",
    "advertises_vht": "has_vht",
    "advertises_ht": "has_ht",
    "carries_rsn": "has_rsn",
    "carries_extended_capabilities": "has_extended_capabilities",
}


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def _trend(health: DataFrame) -> DataFrame:
    return health.where("in_trend").select("run_id", "started_utc")


def frequency_states(frequencies: DataFrame, *keys: str) -> DataFrame:
    """Rows per sample status, and all manifest rows, per `keys`."""
    return frequencies.groupBy(*keys).agg(
        *[
            F.count_if(F.col("sample_status") == status).alias(name)
            for status, name in _STATUS_COLUMNS.items()
        ],
        F.count("*").alias("manifest_frequencies"),
    )


def observation_totals(observations: DataFrame) -> DataFrame:
    """Per run: distinct addresses, beacons and signal summary."""
    per_address = observations.groupBy("run_id", "bssid").agg(
        F.sum("beacons").alias("beacons"),
        F.sum("rssi_mean_dbm").alias("rssi_sum"),
        F.count("rssi_mean_dbm").alias("rssi_n"),
        F.min("rssi_min_dbm").alias("rssi_low"),
        F.max("rssi_max_dbm").alias("rssi_high"),
    )
    return per_address.groupBy("run_id").agg(
        F.count("bssid").alias("observed_bssids"),
        F.coalesce(F.sum("beacons"), F.lit(0)).alias("beacon_frames"),
        F.round(F.try_divide(F.sum("rssi_sum"), F.sum("rssi_n")), 1).alias("mean_rssi_dbm"),
        F.min("rssi_low").alias("min_rssi_dbm"),
        F.max("rssi_high").alias("max_rssi_dbm"),
    )


def band_observation_totals(observations: DataFrame) -> DataFrame:
    """Per run and band: distinct addresses and beacons."""
    per_address = observations.groupBy("run_id", "band", "bssid").agg(
        F.sum("beacons").alias("beacons")
    )
    return per_address.groupBy("run_id", "band").agg(
        F.count("bssid").alias("observed_bssids"),
        F.coalesce(F.sum("beacons"), F.lit(0)).alias("beacon_frames"),
    )


def hourly_metrics(frequencies: DataFrame, observations: DataFrame, health: DataFrame) -> DataFrame:
    """Frequencies drive: a run with observations but no manifest row is absent."""
    return (
        frequency_states(frequencies, "run_id")
        .join(_trend(health), "run_id")
        .join(observation_totals(observations), "run_id", "left")
        .select(
            "run_id", "started_utc", _zero("observed_bssids"), _zero("beacon_frames"),
            "sampled_frequencies", "sampled_empty_frequencies", "regulatory_skips",
            "capture_errors", "manifest_frequencies",
            "mean_rssi_dbm", "min_rssi_dbm", "max_rssi_dbm",
        )
    )


def band_metrics(frequencies: DataFrame, observations: DataFrame, health: DataFrame) -> DataFrame:
    """Per run and band; "attempted" here is every manifest row, skips included."""
    states = (
        frequency_states(frequencies, "run_id", "band")
        .withColumnRenamed("sampled_frequencies", "populated_frequencies")
        .withColumnRenamed("manifest_frequencies", "attempted_frequencies")
    )
    return (
        states.join(_trend(health), "run_id")
        .join(band_observation_totals(observations), ["run_id", "band"], "left")
        .select(
            "run_id", "band", _zero("observed_bssids"), _zero("beacon_frames"),
            "populated_frequencies", "sampled_empty_frequencies", "regulatory_skips",
            "capture_errors", "attempted_frequencies",
        )
    )


def capability_metrics(capabilities: DataFrame, health: DataFrame) -> DataFrame:
    """Advertised capabilities per trend run, with the address count as denominator."""
    counted = capabilities.groupBy("run_id").agg(
        F.count("*").alias("observed_bssids"),
        *[F.count_if(F.col(flag)).alias(name) for name, flag in _CAPABILITY_METRICS.items()],
    )
    return counted.join(_trend(health), "run_id").select(
        "run_id", "started_utc", "observed_bssids", *_CAPABILITY_METRICS
    )


def direct_6ghz(observations: DataFrame) -> DataFrame:
    heard = band_observation_totals(observations.where(F.col("band") == "6GHz"))
    return heard.select(
        "run_id",
        F.col("observed_bssids").alias("direct_bssids"),
        F.col("beacon_frames").alias("direct_beacons"),
    )


def frequency_states_6ghz(frequencies: DataFrame) -> DataFrame:
    return frequency_states(frequencies.where(F.col("band") == "6GHz"), "run_id").select(
        "run_id", "sampled_frequencies", "sampled_empty_frequencies", "manifest_frequencies"
    )


def neighbor_state(rnr: DataFrame) -> DataFrame:
    """Advertised, disabled and unresolved neighbor pairs, and ambiguous rows of all bands.

    Rows collapse to one per (run, transmitter, neighbor) with three flags, so no distinct
    expansion is planned; a NULL neighbor drops out of the pair counts only.
    """
    single = F.col("structure_status") == C.SINGLE
    six = single & (F.col("target_band") == "6GHz")
    has = lambda cond: F.max(F.coalesce(cond, F.lit(False)))
    pairs = rnr.groupBy("run_id", "tx_bssid", "neighbor_bssid").agg(
        has(six).alias("six"),
        has(six & radio.view_disabled(F.col("disabled_link"))).alias("off"),
        has(single & (F.col("target_band") == "unknown")).alias("unresolved"),
        F.count_if(F.col("structure_status") == C.MULTI).alias("ambiguous"),
    )
    named = F.col("tx_bssid").isNotNull() & F.col("neighbor_bssid").isNotNull()
    return pairs.groupBy("run_id").agg(
        F.count_if(named & F.col("six")).alias("advertised_6ghz_neighbors"),
        F.count_if(named & F.col("off")).alias("advertised_6ghz_disabled_links"),
        F.count_if(named & F.col("unresolved")).alias("unresolved_operating_classes"),
        F.sum("ambiguous").alias("ambiguous_rnr_rows"),
    )


def advertised_pairs(rnr: DataFrame) -> DataFrame:
    """Distinct enabled-or-unknown 6 GHz neighbors per run, from single occurrences only."""
    return (
        rnr.where(
            (F.col("structure_status") == C.SINGLE)
            & (F.col("target_band") == "6GHz")
            & F.col("neighbor_bssid").isNotNull()
            & radio.view_enabled_or_unknown(F.col("disabled_link"))
        )
        .select("run_id", "neighbor_bssid")
        .distinct()
    )


def advertised_not_observed(rnr: DataFrame, observations: DataFrame) -> DataFrame:
    """Advertised 6 GHz neighbors never heard in the same run, on any band."""
    heard = observations.select("run_id", F.col("bssid").alias("neighbor_bssid")).distinct()
    return advertised_pairs(rnr).join(heard, ["run_id", "neighbor_bssid"], "left_anti")


def not_observed_counts(rnr: DataFrame, observations: DataFrame) -> DataFrame:
    # The anti join keeps its left side distinct, so a plain count is the distinct count.
    return advertised_not_observed(rnr, observations).groupBy("run_id").agg(
        F.count("*").alias("advertised_not_observed_nonconcurrent")
    )


def address_evidence(observations: DataFrame, rnr: DataFrame) -> DataFrame:
    """Direct, advertised and advertised-but-unheard counts per run in one pass.

    Both inputs are reduced to one row per (run, address) and meet in a single full outer
    join on that key, so each is scanned once and the join reuses the aggregates' shuffle.
    """
    single = F.col("structure_status") == C.SINGLE
    six = single & (F.col("target_band") == "6GHz")
    has = lambda cond: F.max(F.coalesce(cond, F.lit(False)))
    heard = observations.groupBy("run_id", F.col("bssid").alias("address")).agg(
        F.lit(True).alias("heard"),
        has(F.col("band") == "6GHz").alias("direct"),
        F.sum(F.when(F.col("band") == "6GHz", F.col("beacons"))).alias("beacons"),
    )
    pairs = rnr.groupBy("run_id", "tx_bssid", F.col("neighbor_bssid").alias("address")).agg(
        has(six).alias("six"),
        has(six & radio.view_disabled(F.col("disabled_link"))).alias("off"),
        has(six & radio.view_enabled_or_unknown(F.col("disabled_link"))).alias("on"),
        has(single & (F.col("target_band") == "unknown")).alias("unresolved"),
        F.count_if(F.col("structure_status") == C.MULTI).alias("ambiguous"),
    )
    named = F.col("tx_bssid").isNotNull() & F.col("address").isNotNull()
    neighbors = pairs.groupBy("run_id", "address").agg(
        F.count_if(named & F.col("six")).alias("six"), F.count_if(named & F.col("off")).alias("off"),
        F.count_if(named & F.col("unresolved")).alias("unresolved"),
        F.sum("ambiguous").alias("ambiguous"),
        F.bool_or(F.col("address").isNotNull() & F.col("on")).alias("on"),
    )
    return heard.join(neighbors, ["run_id", "address"], "full_outer").groupBy("run_id").agg(
        F.count_if(F.col("direct") & F.col("address").isNotNull()).alias("direct_bssids"),
        F.sum("beacons").alias("direct_beacons"),
        F.sum("six").alias("advertised_6ghz_neighbors"),
        F.sum("off").alias("advertised_6ghz_disabled_links"),
        F.sum("unresolved").alias("unresolved_operating_classes"),
        F.sum("ambiguous").alias("ambiguous_rnr_rows"),
        F.count_if(F.col("on") & F.col("heard").isNull()).alias("advertised_not_observed_nonconcurrent"),
    )


def evidence_6ghz(
    frequencies: DataFrame, observations: DataFrame, rnr: DataFrame, health: DataFrame
) -> DataFrame:
    """6 GHz evidence per trend run.  The run spine drives, so absent evidence reads 0."""
    names = (
        "direct_bssids", "direct_beacons", "sampled_frequencies", "sampled_empty_frequencies",
        "manifest_frequencies", "advertised_6ghz_neighbors", "advertised_6ghz_disabled_links",
        "unresolved_operating_classes", "ambiguous_rnr_rows",
        "advertised_not_observed_nonconcurrent",
    )
    return (
        _trend(health)
        .join(frequency_states_6ghz(frequencies), "run_id", "left")
        .join(address_evidence(observations, rnr), "run_id", "left")
        .select("run_id", "started_utc", *[_zero(n) for n in names])
    )


def readable_evidence_6ghz(
    evidence: DataFrame, frequencies: DataFrame, run: DataFrame
) -> DataFrame:
    """Extension: evidence with the extraction status, and a denominator without skips."""
    visited = frequencies.where(
        (F.col("band") == "6GHz") & (F.col("sample_status") != "regulatory_skip")
    ).groupBy("run_id").agg(F.count("*").alias("visited_frequencies"))
    return (
        evidence.join(run.select("run_id", "extraction_status"), "run_id", "left")
        .join(visited, "run_id", "left")
        .withColumn("visited_frequencies", _zero("visited_frequencies"))
    )

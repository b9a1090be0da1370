"""Profile of observations: identity, names, radio conditions and data quality.

Every operator keeps ``run_id`` as a group key, so one job profiles a whole series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietband import config as C
from quietband.functions import names, radio, times
from quietband.operators.membership import not_regulatory_skip


def observation_features(observations: DataFrame) -> DataFrame:
    """Observations with address and name features and the span they were heard over."""
    bssid = F.col("bssid")
    return observations.withColumns(
        {
            "locally_administered": radio.is_locally_administered(bssid),
            "multicast": radio.is_multicast(bssid),
            "oui": radio.oui(bssid),
            "radio_family": radio.radio_family(bssid),
            **names.classify(F.col("ssid")),
            "dwell_span_s": times.dwell_span_seconds(F.col("first_seen"), F.col("last_seen")),
        }
    )


def source_order() -> Column:
    """Order of observation rows in a sweep's source table."""
    return F.struct(
        radio.band_rank(F.col("band")), F.col("frequency_mhz"), F.col("bssid"),
        F.col("first_seen"), F.col("beacons"), F.col("ssid"),
    )


# --- Coverage -----------------------------------------------------------------------------

def coverage(frequencies: DataFrame) -> DataFrame:
    status = F.col("sample_status")
    return frequencies.groupBy("run_id").agg(
        F.count("*").alias("listed"),
        F.count_if(status != "regulatory_skip").alias("attempted"),
        F.count_if(status == "sampled").alias("populated"),
        F.count_if(status == "sampled_empty").alias("empty"),
        F.count_if(status == "regulatory_skip").alias("skipped"),
    )


def coverage_by_band(frequencies: DataFrame) -> DataFrame:
    status = F.col("sample_status")
    return frequencies.groupBy("run_id", "band").agg(
        F.count("*").alias("freqs"),
        F.count_if(status != "regulatory_skip").alias("attempted"),
        F.count_if(status == "sampled").alias("populated"),
        F.coalesce(F.sum("bssid_count"), F.lit(0)).alias("bssids"),
        F.coalesce(F.sum("beacon_count"), F.lit(0)).alias("beacons"),
    )


def state_by_outcome(frequencies: DataFrame) -> DataFrame:
    """Cross-tab of regulatory state and sample status; any status beyond the four counts as `other`."""
    status = F.col("sample_status")
    known = F.coalesce(status.isin(*C.SAMPLE_STATUSES), F.lit(False))
    return frequencies.groupBy("run_id", "regulatory_state").agg(
        *[F.count_if(status == s).alias(s) for s in C.SAMPLE_STATUSES], F.count_if(~known).alias("other")
    )


def positive_control(frequencies: DataFrame) -> DataFrame:
    """Detections per band; a band with none is unvalidated, not shown to be empty."""
    # The set of regulatory states is a closed vocabulary of flag combinations.
    bands = not_regulatory_skip(frequencies).groupBy("run_id", "band").agg(
        F.count_if(F.col("sample_status") == "sampled").alias("detections"),
        F.count("*").alias("attempted"),
        F.array_sort(F.collect_set("regulatory_state")).alias("states"),
    )
    return bands.select(
        "run_id", "band", "detections", "attempted",
        F.when(F.col("detections") == 0, "unvalidated").otherwise("receiver_confirmed").alias("verdict"),
        F.when(F.col("detections") == 0, F.array_join("states", ", ")).alias("regulatory_states"),
    )


# --- Reception ------------------------------------------------------------------------------

def _modal(rows: DataFrame, column: str) -> DataFrame:
    """Most frequent value per run, the smallest one on a tie."""
    counts = rows.where(F.col(column).isNotNull()).groupBy("run_id", column).count()
    return counts.groupBy("run_id").agg(
        F.max_by(column, F.struct("count", -F.col(column))).alias(column)
    )


def reception_bounds(observations: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Best reception of each run.  An upper bound of one sweep, not a calibration."""
    interval = _modal(observations, "beacon_interval_tu")
    dwell = _modal(frequencies.where(F.col("dwell_seconds") > 0), "dwell_seconds")
    # One row per distinct ratio, so finding the rows at the bound re-reads no raw rows.
    ratios = observations.groupBy("run_id", "beacon_reception_ratio").agg(
        F.count("*").alias("n"), F.max("beacons").alias("best")
    )
    top = ratios.groupBy("run_id").agg(
        F.max("beacon_reception_ratio").alias("max_ratio"),
        F.max("best").alias("best_count"), F.sum("n").alias("observations"),
    )
    at_bound = (
        ratios.join(top.select("run_id", "max_ratio"), "run_id")
        .where(F.col("beacon_reception_ratio") >= F.col("max_ratio") - F.lit(1e-9))
        .groupBy("run_id").agg(F.sum("n").alias("at_bound"))
    )
    joined = interval.join(top, "run_id").join(dwell, "run_id", "left").join(at_bound, "run_id", "left")
    seconds = F.coalesce("dwell_seconds", F.lit(C.DEFAULT_DWELL_SECONDS)).cast("bigint")
    return joined.select(
        "run_id", seconds.alias("dwell_seconds"), "beacon_interval_tu",
        (seconds / (F.col("beacon_interval_tu") * F.lit(C.TU_SECONDS))).alias("expected_count"),
        "best_count", "max_ratio",
        ((1 - F.col("max_ratio")) * 100).alias("shortfall_pct"),
        F.coalesce("at_bound", F.lit(0)).alias("at_bound"), "observations",
    )


# --- Identity -------------------------------------------------------------------------------

def identity_summary(features: DataFrame) -> DataFrame:
    """Addresses, probable radios and administration bits per run."""
    addresses = features.groupBy("run_id", "radio_family", "bssid").agg(
        F.bool_or("locally_administered").alias("local"), F.bool_or("multicast").alias("group")
    )
    families = addresses.groupBy("run_id", "radio_family").agg(
        F.count("*").alias("n"), F.count_if(F.col("local")).alias("local"),
        F.count_if(F.col("group")).alias("group"),
    )
    totals = families.groupBy("run_id").agg(
        F.sum("n").alias("bssids"), F.count("*").alias("radio_families"),
        F.sum("local").alias("locally_administered"), F.sum("group").alias("multicast"),
    )
    return totals.select(
        "run_id", "bssids", "radio_families",
        (F.col("bssids") / F.col("radio_families")).alias("bssids_per_radio"),
        "locally_administered",
        (F.col("bssids") - F.col("locally_administered")).alias("globally_administered"),
        (F.col("locally_administered") * 100 / F.col("bssids")).alias("locally_administered_pct"),
        "multicast",
    )


def radio_families(features: DataFrame) -> DataFrame:
    """Probable radios per run; their names are the rows of ``radio_family_names``."""
    # Bands are a closed vocabulary, so the collected set stays tiny.
    per_address = features.groupBy("run_id", "radio_family", "bssid", "band").agg(
        F.sum("rssi_mean_dbm").alias("rssi_sum"), F.count("rssi_mean_dbm").alias("rssi_n")
    )
    per_band = per_address.groupBy("run_id", "radio_family", "bssid").agg(
        F.collect_set("band").alias("bands"),
        F.sum("rssi_sum").alias("rssi_sum"), F.sum("rssi_n").alias("rssi_n"),
    )
    return per_band.groupBy("run_id", "radio_family").agg(
        F.count("bssid").alias("bssids"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("bands")))), "/").alias("bands"),
        F.try_divide(F.sum("rssi_sum"), F.sum("rssi_n")).alias("mean_rssi_dbm"),
    )


def radio_family_names(features: DataFrame) -> DataFrame:
    """Distinct names per probable radio, one row each so no cell grows with the data."""
    return features.select(
        "run_id", "radio_family",
        F.when(F.col("ssid") == "", C.HIDDEN).otherwise(F.col("ssid")).alias("ssid"),
    ).distinct()


# --- Names ----------------------------------------------------------------------------------

def per_address_names(features: DataFrame) -> DataFrame:
    """First name features of each address in source order; provider is the first non-null."""
    order = source_order()
    return features.groupBy("run_id", "bssid").agg(
        F.min_by(F.struct("hidden", "isp_default", "shared_service"), order).alias("first"),
        F.min_by("provider_family", F.when(F.col("provider_family").isNotNull(), order)).alias("provider_family"),
    ).select("run_id", "bssid", "first.*", "provider_family")


def ssid_profile(features: DataFrame) -> DataFrame:
    per_address = per_address_names(features).groupBy("run_id").agg(
        F.count("*").alias("bssids"),
        F.count_if("hidden").alias("hidden_bssids"),
        F.count_if("isp_default").alias("default_names"),
        F.count_if("shared_service").alias("shared_service_bssids"),
    )
    named = features.where(F.col("ssid") != "").select("run_id", "ssid").distinct().groupBy("run_id").agg(
        F.count("*").alias("unique_ssids")
    )
    return per_address.join(named, "run_id", "left").withColumn(
        "unique_ssids", F.coalesce("unique_ssids", F.lit(0))
    )


def shared_services(features: DataFrame) -> DataFrame:
    """Addresses and probable radios behind each shared-service name."""
    # An address lies in exactly one family, so family counts add up.
    families = (
        features.where("shared_service").select("run_id", "ssid", "radio_family", "bssid").distinct()
        .groupBy("run_id", "ssid", "radio_family").agg(F.count("*").alias("n"))
    )
    return families.groupBy("run_id", "ssid").agg(
        F.sum("n").alias("bssids"), F.count("*").alias("radio_families")
    )


def provider_counts(features: DataFrame) -> DataFrame:
    return (
        per_address_names(features).where(F.col("provider_family").isNotNull())
        .groupBy("run_id", "provider_family").agg(F.count("*").alias("bssids"))
    )


# --- Radio conditions -----------------------------------------------------------------------

def rf_profile(observations: DataFrame) -> DataFrame:
    per_address = observations.groupBy("run_id", "band", "bssid").agg(
        F.count("*").alias("obs"),
        F.min("rssi_min_dbm").alias("lo"), F.max("rssi_max_dbm").alias("hi"),
        F.sum("rssi_mean_dbm").alias("rssi_sum"), F.count("rssi_mean_dbm").alias("rssi_n"),
        F.sum("beacon_reception_ratio").alias("ratio_sum"),
        F.count("beacon_reception_ratio").alias("ratio_n"),
    )
    return per_address.groupBy("run_id", "band").agg(
        F.sum("obs").alias("obs"), F.count("bssid").alias("bssids"), F.min("lo").alias("rssi_min"),
        F.try_divide(F.sum("rssi_sum"), F.sum("rssi_n")).alias("rssi_mean"),
        F.max("hi").alias("rssi_max"),
        F.try_divide(F.sum("ratio_sum"), F.sum("ratio_n")).alias("ratio_mean"),
    )


def channel_occupancy(observations: DataFrame) -> DataFrame:
    keys = ("run_id", "band", "frequency_mhz", "channel")
    per_address = observations.groupBy(*keys, "bssid").agg(F.sum("beacons").alias("beacons"))
    return per_address.groupBy(*keys).agg(
        F.count("bssid").alias("bssids"), F.sum("beacons").alias("beacons")
    )


def multi_frequency_addresses(observations: DataFrame) -> DataFrame:
    """Addresses heard on more than one frequency, with those frequencies in order."""
    order = source_order()
    per_frequency = observations.groupBy("run_id", "bssid", "frequency_mhz").agg(
        F.min(F.struct(order.alias("o"), F.col("ssid").alias("s"))).alias("first")
    )
    # A frequency plan lists about a hundred frequencies: the collected set is that small.
    return (
        per_frequency.groupBy("run_id", "bssid")
        .agg(
            F.count("frequency_mhz").alias("n_frequencies"),
            F.array_sort(F.collect_set("frequency_mhz")).alias("list"),
            F.min("first").alias("first"),
        )
        .where(F.col("n_frequencies") > 1)
        .select(
            "run_id", "bssid",
            F.when(F.col("first.s") == "", C.HIDDEN).otherwise(F.col("first.s")).alias("label"),
            "n_frequencies", F.array_join("list", ", ").alias("frequencies"),
        )
    )


def quality_flags(observations: DataFrame, frequencies: DataFrame) -> DataFrame:
    """(run_id, flag, observations, value); capture errors are always stated, others if any."""
    thin = F.col("beacons") < C.THIN_BEACONS
    heard = observations.groupBy("run_id").agg(
        F.count_if(thin).alias("thin_beacon_count"),
        F.min("beacons").alias("fewest"),
        F.count_if(F.col("rssi_max_dbm") - F.col("rssi_min_dbm") > C.RSSI_SPREAD_DB).alias("wide_rssi_spread"),
        F.count_if(F.col("beacon_reception_ratio") > 1.0).alias("ratio_above_one"),
    )
    errors = frequencies.groupBy("run_id").agg(
        F.count_if(
            (F.col("error") != "") & (F.col("sample_status") != "regulatory_skip")
        ).alias("capture_errors")
    )
    none = F.lit(None).cast("bigint")
    row = lambda name, value=none: F.struct(
        F.lit(name).alias("flag"), F.coalesce(F.col(name), F.lit(0)).alias("n"), value.alias("value")
    )
    flags = F.array(
        row("thin_beacon_count", F.col("fewest")), row("wide_rssi_spread"),
        row("ratio_above_one"), row("capture_errors"),
    )
    return (
        errors.join(heard, "run_id", "full_outer")
        .select("run_id", F.inline(flags))
        .where((F.col("n") > 0) | (F.col("flag") == "capture_errors"))
    )


def sweep_window(observations: DataFrame) -> DataFrame:
    return observations.groupBy("run_id").agg(
        F.min("first_seen").alias("window_start"), F.max("last_seen").alias("window_end")
    )

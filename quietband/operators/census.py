"""Capture census: every pass is one aggregation over the same decoded frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietband import config as C
from quietband.functions import names, radio
from quietband.functions.cells import filled, joined
from quietband.operators.enrichment import STANDARD, element_counts

DETECTED, LINK_DISABLED, NOT_OBSERVED = C.DETECTED, C.LINK_DISABLED, C.NOT_OBSERVED

_ADVERTISEMENT = ("tx_bssid", "tx_ssid", "op_class", "channel", "neighbor", "short_ssid",
                  "bss_params", "mld_link_id", "disabled_link")


def _frame_order() -> Column:
    return F.struct("pcap_file", "frame_number")


# --- Captures and fields --------------------------------------------------------------------

def capture_counts(captures: DataFrame) -> DataFrame:
    """Populated captures of all captures per run; only file sizes are read."""
    return captures.groupBy("run_id").agg(
        F.count_if(F.col("length") > C.EMPTY_CAPTURE_BYTES).alias("populated_captures"),
        F.count("*").alias("captures"),
    )


def radiotap_population(
    frames: DataFrame, captures: DataFrame, sample: int | None = None
) -> DataFrame:
    """How each Radiotap field is filled in the largest capture; `sample` limits it to its first packets."""
    largest = captures.where(F.col("length") > C.EMPTY_CAPTURE_BYTES).groupBy("run_id").agg(
        F.min_by("pcap_file", F.struct(-F.col("length"), F.col("pcap_file"))).alias("pcap_file")
    )
    wanted = F.col("error").isNull() if sample is None else F.col("error").isNull() & (F.col("frame_number") <= sample)
    chosen = frames.where(wanted).join(
        largest, ["run_id", "pcap_file"], "left_semi"
    )
    measures = []
    for name in C.RADIOTAP_PROBE:
        values = F.coalesce(F.col(name), F.array().cast("array<string>"))
        on = F.size(F.filter(values, lambda v: v.isin("1", "True")))
        measures += [
            F.count_if(F.size(values) > 0).alias(f"{name}__present"),
            F.sum(F.size(values)).alias(f"{name}__values"),
            F.sum(on).alias(f"{name}__on"),
        ]
    wide = chosen.groupBy("run_id", "pcap_file").agg(F.count("*").alias("frames"), *measures)
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("field"), F.col(f"{n}__present").alias("present"),
                F.col(f"{n}__values").alias("n_values"), F.col(f"{n}__on").alias("set_true"),
            )
            for n in C.RADIOTAP_PROBE
        ]
    )
    per_frame = F.coalesce(F.try_divide(F.col("n_values"), F.col("present")), F.lit(0.0))
    return wide.select("run_id", "pcap_file", "frames", F.inline(rows)).select(
        "run_id", "pcap_file", "field", "frames", "present",
        (100 * F.col("present") / F.col("frames")).alias("present_pct"),
        per_frame.alias("values_per_frame"), "set_true",
        F.when(F.col("present") == 0, "ABSENT")
        .when(per_frame > 1.5, "POPULATED_REPEATED")
        .when(F.col("field").endswith("badfcs"), "POPULATED_FLAG")
        .otherwise("POPULATED").alias("verdict"),
    )


def truncation(frames: DataFrame) -> DataFrame:
    """Whether captured frames were cut below their length on air."""
    return frames.where(F.col("wire_length").isNotNull()).groupBy("run_id").agg(
        F.count("*").alias("frames"),
        F.max("captured_length").alias("largest_captured"),
        F.count_if(F.col("captured_length") < F.col("wire_length")).alias("truncated"),
    )


# --- Names and elements -----------------------------------------------------------------------

def observed_names(frames: DataFrame) -> DataFrame:
    """Name of each heard address: the first one that is not hidden, else hidden."""
    ssid = names.decode_ssid(F.col("ssid_hex"))
    heard = frames.where(filled(F.col("bssid")).isNotNull())
    return heard.groupBy("run_id", F.lower(F.trim("bssid")).alias("bssid")).agg(
        F.coalesce(
            F.min_by(ssid, F.when(ssid != C.HIDDEN, _frame_order())), F.lit(C.HIDDEN)
        ).alias("ssid")
    )


def element_census(frames: DataFrame) -> DataFrame:
    """Frames and addresses per element of both namespaces, with its name."""
    totals = (
        element_counts(frames).where(F.col("element").isNotNull())
        .groupBy("run_id", "namespace", "element")
        .agg(F.sum("frames").alias("frames"), F.count_if(F.col("bssid") != "").alias("bssids"))
    )
    return totals.withColumn(
        "name",
        F.when(F.col("namespace") == STANDARD, radio.element_name(F.col("element")))
        .otherwise(radio.extension_name(F.col("element"))),
    )


def absent_priority_elements(frames: DataFrame) -> DataFrame:
    """Priority standard elements that no frame of a run carried."""
    wanted = F.explode(F.array(*[F.lit(e) for e in C.PRIORITY_ELEMENTS])).alias("element")
    runs = frames.select("run_id").distinct().select("run_id", wanted)
    seen = (
        frames.select("run_id", F.explode("tags").alias("element"))
        .where(F.col("element").isin(*C.PRIORITY_ELEMENTS)).distinct()
    )
    return runs.join(seen, ["run_id", "element"], "left_anti").withColumn(
        "name", radio.element_name(F.col("element"))
    )


def generations_advertised(frames: DataFrame) -> DataFrame:
    """Wi-Fi generations any frame of a run advertises; an empty list reads as none."""
    found = [
        F.bool_or(F.arrays_overlap("exts", F.array(*[F.lit(i) for i in ids]))).alias(name)
        for name, ids in C.GENERATIONS
    ]
    listed = F.array_join(
        F.array_compact(F.array(*[F.when(F.col(f"`{n}`"), F.lit(n)) for n, _ in C.GENERATIONS])), ", "
    )
    return frames.groupBy("run_id").agg(*found).select(
        "run_id", F.coalesce(F.nullif(listed, F.lit("")), F.lit("none above VHT")).alias("generations")
    )


def ie_census_table(capabilities: DataFrame, observed: DataFrame) -> DataFrame:
    """Element ids per address next to the best known name."""
    return capabilities.join(observed, ["run_id", "bssid"], "left").select(
        "run_id", "bssid", F.coalesce("ssid", F.lit("")).alias("ssid"),
        F.col("elements").alias("element_ids"),
    )


def identity_counts(frames: DataFrame) -> DataFrame:
    """Frames per identity structure, one row per check."""
    tag = lambda n: F.array_contains("tags", n)
    some = lambda c: F.size(F.coalesce(F.col(c), F.array())) > 0
    checks = {
        **{name: tag(element) for name, element in C.ELEMENT_CHECKS.items()},
        "any_extension_element": some("exts"),
        "he_bss_color": some("he_bss_color"),
        "rnr_mld_link_id": some("rnr_mld_link_id"),
        "fcs_failures": F.arrays_overlap("radiotap_flags_badfcs", F.array(F.lit("1"), F.lit("True"))),
    }
    wide = frames.groupBy("run_id").agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("frames")) for n in checks])
    return wide.select("run_id", F.inline(rows))


# --- Neighbor reports ---------------------------------------------------------------------------

def ambiguous_reports(rnr: DataFrame) -> DataFrame:
    """Neighbor-report rows per run, and those no interpretation may use."""
    return rnr.groupBy("run_id").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("structure_status") == C.MULTI).alias("skipped_ambiguous"),
    )


def advertisements(rnr: DataFrame) -> DataFrame:
    """Distinct single-occurrence advertisements with their beacon counts."""
    cells = {
        "tx_bssid": F.col("tx_bssid"), "tx_ssid": F.col("tx_ssid"),
        "op_class": F.col("raw_op_class"), "channel": F.col("raw_channel"),
        "neighbor": F.col("raw_neighbor_bssid"), "short_ssid": F.col("raw_short_ssid"),
        "bss_params": F.col("raw_bss_params"), "mld_link_id": F.col("raw_mld_link_id"),
        "disabled_link": F.col("raw_disabled_link"),
    }
    return (
        rnr.where(F.col("structure_status") == C.SINGLE)
        .groupBy("run_id", *[F.coalesce(v, F.lit("")).alias(k) for k, v in cells.items()])
        .agg(F.count("*").alias("beacons"), F.min(_frame_order()).alias("first"))
    )


def name_pool(observed: DataFrame) -> DataFrame:
    """Heard names by short SSID; a hash collision keeps the alphabetically first name."""
    return (
        observed.where((F.col("ssid") != "") & ~F.col("ssid").startswith("<"))
        .groupBy("run_id", names.short_ssid(F.col("ssid")).alias("hash"))
        .agg(F.min("ssid").alias("neighbor_ssid"))
    )


def resolve_short_ssids(adverts: DataFrame, observed: DataFrame) -> DataFrame:
    """Advertisements with the heard name their short SSID stands for, or NULL.

    Both sides are distinct on their keys before the join, so a popular name is one row.
    """
    hashed = adverts.withColumn("hash", names.short_ssid_value(F.col("short_ssid")))
    return hashed.join(name_pool(observed), ["run_id", "hash"], "left").drop("hash")


def advertised_targets(adverts: DataFrame) -> DataFrame:
    """Advertisements with band, MHz, flags and the census disabled reading."""
    digits = F.col("op_class").rlike("^[0-9]+$") & F.col("channel").rlike("^[0-9]+$")
    op, channel = (F.col(c).try_cast("bigint") for c in ("op_class", "channel"))
    return adverts.withColumns(
        {
            "neighbor_bssid": radio.census_mac(F.col("neighbor")),
            "band": F.when(digits, radio.opclass_band(op)).otherwise("unknown"),
            "frequency_mhz": F.when(digits, radio.opclass_mhz(op, channel)),
            "is_disabled": radio.census_disabled(F.col("disabled_link")),
            "bss_flags": F.array_join(radio.bss_parameter_names(F.col("bss_params")), ", "),
        }
    )


def neighbor_outcomes(adverts: DataFrame, observed: DataFrame) -> DataFrame:
    """Three-way outcome per advertised neighbor.

    Where a neighbor has several advertisements the least frequent one speaks for it, and
    among equally frequent ones the one first heard last.
    """
    known = advertised_targets(resolve_short_ssids(adverts, observed)).where(
        F.col("neighbor_bssid") != ""
    )
    speaker = known.groupBy("run_id", "neighbor_bssid").agg(
        F.max_by(
            F.struct("band", "frequency_mhz", "neighbor_ssid", "tx_bssid", "is_disabled"),
            F.struct(-F.col("beacons"), F.col("first"), *[F.col(c) for c in _ADVERTISEMENT]),
        ).alias("s")
    )
    heard = observed.select("run_id", F.col("bssid").alias("neighbor_bssid"), F.lit(True).alias("heard"))
    return speaker.join(heard, ["run_id", "neighbor_bssid"], "left").select(
        "run_id", "neighbor_bssid",
        F.when(F.col("s.is_disabled"), LINK_DISABLED)
        .when(F.col("heard"), DETECTED).otherwise(NOT_OBSERVED).alias("outcome"),
        F.col("s.band").alias("band"), F.col("s.frequency_mhz").alias("frequency_mhz"),
        F.coalesce("s.neighbor_ssid", F.lit("?")).alias("ssid"),
        F.col("s.tx_bssid").alias("advertised_by"),
    )


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    """Outcomes per run; the share counts enabled or unknown-state neighbors only."""
    counted = outcomes.groupBy("run_id").agg(
        F.count_if(F.col("outcome") == DETECTED).alias("detected"),
        F.count_if(F.col("outcome") == NOT_OBSERVED).alias("not_observed"),
        F.count_if(F.col("outcome") == LINK_DISABLED).alias("disabled"),
    )
    enabled = F.col("detected") + F.col("not_observed")
    return counted.withColumn(
        "detected_pct",
        F.when(enabled > 0, F.floor(100 * F.col("detected") / enabled)).cast("bigint"),
    )


# --- BSS Load -----------------------------------------------------------------------------------

def load_census(frames: DataFrame) -> DataFrame:
    """BSS Load rows in census shape: no frame identity, verbatim cells."""
    return frames.where(F.array_contains("tags", C.TAG_BSS_LOAD)).select(
        "run_id", F.col("pcap_file").alias("pcap"), "bssid", "ssid_hex",
        *[F.coalesce(joined(F.col(n)), F.lit("")).alias(n) for n in C.LOAD_CELLS],
        names.decode_ssid(F.col("ssid_hex")).alias("ssid"),
    )


def load_ranges(load: DataFrame) -> DataFrame:
    """Utilization and station range per address; percentages are floored shares of 255."""
    digits = lambda c: F.when(F.col(c).rlike("^[0-9]+$"), F.col(c).try_cast("bigint"))
    ranges = load.groupBy("run_id", "bssid").agg(
        F.min_by("ssid", _frame_order()).alias("ssid"), F.count("*").alias("frames"),
        F.min(digits("raw_utilization")).alias("utilization_min"),
        F.max(digits("raw_utilization")).alias("utilization_max"),
        F.min(digits("raw_station_count")).alias("stations_min"),
        F.max(digits("raw_station_count")).alias("stations_max"),
    )
    share = lambda c: F.floor(F.col(c) * 100 / 255).cast("bigint")
    return ranges.withColumns(
        {
            "utilization_min_pct": share("utilization_min"),
            "utilization_max_pct": share("utilization_max"),
        }
    )


def rnr_census(rnr: DataFrame) -> DataFrame:
    """Neighbor-report rows in census column order, blanks as empty text."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return rnr.select(
        "run_id", F.col("pcap_file").alias("pcap"), text("frame_number").alias("frame_number"),
        text("frame_time_epoch").alias("frame_time_epoch"), "tx_bssid",
        *[text(f"raw_{column}").alias(name) for name, column in C.RNR_CELLS.items()],
        "structure_status", text("unpaired_fields").alias("unpaired_fields"), "tx_ssid",
    )


"""Briefing numbers in one long shape: every ratio keeps numerator and denominator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quietband import config as C
from quietband.config import SeriesConfig
from quietband.functions import radio
from quietband.operators import health as H

_SCOPE, _HEALTH, _COVERAGE, _SNAPSHOT, _CAPABILITY, _SIX, _LOAD, _QUALITY, _COMMISSIONING, _PROVENANCE = (
    C.BRIEFING_SECTIONS
)
_CAPABILITIES = ("advertises_he", "advertises_he_6ghz", "advertises_eht", "advertises_mld",
                 "advertises_multiple_bssid", "carries_rnr", "carries_bss_load")
_LATEST_CAPABILITIES = _CAPABILITIES[:5]
_EVIDENCE = ("direct_bssids", "direct_beacons", "sampled_frequencies", "sampled_empty_frequencies",
             "manifest_frequencies", "advertised_6ghz_neighbors", "advertised_6ghz_disabled_links",
             "unresolved_operating_classes", "ambiguous_rnr_rows",
             "advertised_not_observed_nonconcurrent")


# --- Wide results ---------------------------------------------------------------------------

def coverage_totals(bands: DataFrame) -> DataFrame:
    """Seven sums of the band metrics per band."""
    names = ("populated_frequencies", "sampled_empty_frequencies", "regulatory_skips",
             "capture_errors", "attempted_frequencies", "observed_bssids", "beacon_frames")
    return bands.groupBy("band").agg(*[F.sum(n).alias(n) for n in names])


#: Bits below the buckets of each step of the median's search: no bucket has more than 2^21 smaller ones in it.
_NARROWING = (42, 21, 0)


def _medians(long: DataFrame) -> DataFrame:
    """Exact median of `v` per measure, averaging the middle pair; nulls do not count.

    Values are counted.  Then each step sums the counts of the buckets inside those that hold the
    middle positions, by map-side combining, and keeps the one or two inner buckets they fall in;
    the last step's buckets are single values.  A window sees the inner buckets of one bucket only,
    at most 2^21 of them, however many runs or distinct values there are.
    """
    counts = long.where("v is not null").groupBy("measure", F.col("v").cast("long").alias("v")).agg(
        F.count("*").alias("n")
    )
    # Positions of the middle pair, counted from 1; they coincide for an odd total.
    held = counts.groupBy("measure").agg(F.sum("n").alias("total")).select(
        "measure", F.lit(0).cast("long").alias("outer"),
        F.floor((F.col("total") + 1) / 2).alias("low"), (F.floor(F.col("total") / 2) + 1).alias("high"),
        F.lit(0).cast("long").alias("before"),
    )
    outer = F.lit(0).cast("long")
    for bits in _NARROWING:
        buckets = counts.select(
            F.col("measure").alias("of"), outer.alias("in"), F.shiftright("v", bits).alias("bucket"), "n"
        )
        # Null-safe, so that no filter on one step's buckets keeps the counts from being shared by all.
        inside = buckets.join(held, F.col("of").eqNullSafe(F.col("measure")) & F.col("in").eqNullSafe(F.col("outer")))
        summed = inside.groupBy("measure", "outer", "bucket", "low", "high", "before").agg(F.sum("n").alias("n"))
        upto = F.col("before") + F.sum("n").over(W.partitionBy("measure", "outer").orderBy("bucket"))
        held = summed.withColumn("upto", upto).where((F.col("upto") >= F.col("low")) & (F.col("upto") - F.col("n") < F.col("high")))
        held = held.select(
            "measure", F.col("bucket").alias("outer"), "low", "high", (F.col("upto") - F.col("n")).alias("before"), "upto"
        )
        if bits:
            held = held.drop("upto")
        outer = F.shiftright("v", bits)
    at = lambda pos: F.min(F.when(F.col("upto") >= F.col(pos), F.col("outer")))
    return held.groupBy("measure").agg(((at("low") + at("high")) / 2).alias("median"))


def snapshot(hourly: DataFrame) -> DataFrame:
    """Latest, lowest, middle and highest value over the trend runs, one row per measure."""
    measures = ("observed_bssids", "beacon_frames")
    long = hourly.select(
        "run_id",
        F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("v")) for m in measures])),
    )
    extremes = long.groupBy("measure").agg(
        F.count("*").alias("trend_runs"), F.max_by("v", "run_id").alias("latest"),
        F.min("v").alias("lowest"), F.max("v").alias("highest"),
    )
    return extremes.join(_medians(long), "measure").select(
        "measure", "trend_runs", "latest", "lowest", "median", "highest"
    )


def recent_runs(hourly: DataFrame, limit: int = C.RECENT_RUNS) -> DataFrame:
    """The last trend runs of the series, newest first."""
    return hourly.orderBy(F.col("run_id").desc()).limit(limit)


def omitted_runs(hourly: DataFrame, limit: int = C.RECENT_RUNS) -> DataFrame:
    """How many trend runs the recent-run table leaves out."""
    return hourly.agg(
        F.count("*").alias("trend_runs"),
        F.greatest(F.count("*") - limit, F.lit(0)).alias("omitted"),
    )


def latest_row(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.col("run_id").desc()).limit(1)


def capability_totals(capabilities: DataFrame) -> DataFrame:
    return capabilities.agg(
        *[F.sum(n).alias(n) for n in _CAPABILITIES], F.sum("observed_bssids").alias("observed_bssids")
    )


def evidence_totals(evidence: DataFrame) -> DataFrame:
    return evidence.agg(*[F.sum(n).alias(n) for n in _EVIDENCE])


def unresolved_fields(resolution: DataFrame) -> DataFrame:
    return resolution.where(F.col("status") == "unresolved").select("logical_name").distinct()


def ambiguity(rnr: DataFrame) -> DataFrame:
    """Structurally ambiguous rows and the runs they lie in."""
    per_run = rnr.where(F.col("structure_status") == C.MULTI).groupBy("run_id").agg(
        F.count("*").alias("n")
    )
    return per_run.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("ambiguous_rows"), F.count("*").alias("runs"))


def extraction_failures(run: DataFrame) -> DataFrame:
    return run.where(F.col("extraction_status").isin("partial", "failed")).select(
        "run_id", "extraction_status", "error"
    )


def load_summary(load: DataFrame) -> DataFrame:
    """BSS Load over the whole series.

    Frames combine map-side to one row per address and one per run; the two short lists are
    stacked and summed, which needs no expansion for the two distinct counts.
    """
    addresses = load.groupBy("bssid").agg(
        F.count("*").alias("n"),
        F.min("station_count").alias("s_lo"), F.max("station_count").alias("s_hi"),
        F.min("utilization").alias("u_lo"), F.max("utilization").alias("u_hi"),
    ).withColumn("address", F.col("bssid").isNotNull()).drop("bssid")
    runs = load.select("run_id").distinct().select(F.lit(True).alias("run"))
    return addresses.unionByName(runs, allowMissingColumns=True).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("frames"),
        F.count_if("address").alias("bssids"), F.count_if("run").alias("runs"),
        F.min("s_lo").alias("stations_min"), F.max("s_hi").alias("stations_max"),
        F.min("u_lo").alias("utilization_min"), F.max("u_hi").alias("utilization_max"),
    )


def commissioning_summary(frequencies: DataFrame, observations: DataFrame, runs: tuple[str, ...]) -> DataFrame:
    """Every configured commissioning run, straight from the source tables, outside the derived layer.

    A run without a manifest table is not `present` and has zeros.
    """
    freq = frequencies.groupBy("run_id").agg(
        F.count("*").alias("frequencies"), F.count_if(F.col("sample_status") == "sampled").alias("sampled")
    )
    heard = observations.groupBy("run_id", "bssid").agg(F.count("*").alias("n")).groupBy("run_id").agg(
        F.sum("n").alias("observations"), F.count("bssid").alias("bssids")
    )
    named = frequencies.sparkSession.createDataFrame([(r,) for r in runs], "run_id string")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return named.join(freq, "run_id", "left").join(heard, "run_id", "left").select(
        "run_id", F.col("frequencies").isNotNull().alias("present"), zero("frequencies"), zero("sampled"),
        F.coalesce("observations", F.lit(0)).alias("observations"),
        F.coalesce("bssids", F.lit(0)).alias("bssids"),
    )


def markers(run: DataFrame, health: DataFrame, hourly: DataFrame) -> DataFrame:
    """Data cutoff and latest runs: (marker, text)."""
    row = lambda df, col, name: df.agg(F.max(col).alias("text")).select(
        F.lit(name).alias("marker"), "text"
    )
    # Three one-row aggregates over run-grain inputs.
    return (
        row(run, "started_utc", "data_cutoff")
        .unionByName(row(health, "run_id", "latest_input"))
        .unionByName(row(hourly, "run_id", "last_successful_sweep"))
        .unionByName(row(run, "run_id", "last_discovered_attempt"))
    )


def derivation_counts(run: DataFrame) -> DataFrame:
    return run.groupBy("extraction_status").agg(F.count("*").alias("runs"))


def findings(
    run: DataFrame, health: DataFrame, rnr: DataFrame, resolution: DataFrame
) -> DataFrame:
    """(finding, subject, detail, n): one row per item, so a long outage is many rows."""
    text = lambda c: F.col(c).cast("string")
    one = F.lit(1).cast("bigint")
    none = F.lit(None).cast("string")
    row = lambda name, subject, detail, n: [
        F.lit(name).alias("finding"), subject.alias("subject"), detail.alias("detail"), n.alias("n")
    ]
    troubled = (
        health.where(F.col("state").isin(C.FAILED, C.MALFORMED, C.RUNNING) & F.col("eligible"))
        .groupBy("state").agg(F.count("*").alias("n"))
    )
    doubtful = ambiguity(rnr).where(F.col("ambiguous_rows") > 0)
    return (
        unresolved_fields(resolution).select(*row("unresolved_field", text("logical_name"), none, one))
        .unionByName(doubtful.select(*row("ambiguous_rnr_rows", none, text("runs"), F.col("ambiguous_rows"))))
        .unionByName(extraction_failures(run).select(
            *row("derivation_incomplete", text("run_id"),
                 F.concat_ws(": ", "extraction_status", F.coalesce("error", F.lit("no detail"))), one)))
        .unionByName(troubled.select(*row("attempt_state", text("state"), none, F.col("n"))))
        .unionByName(health.where(F.col("state") == C.MISSING_SLOT).select(
            *row("missing_slot", text("run_id"), none, one)))
    )


# --- Long form --------------------------------------------------------------------------------

_SHAPE = {"metric": "STRING", "run_id": "STRING", "numerator": "BIGINT", "denominator": "BIGINT",
          "value": "DOUBLE", "label": "STRING"}


def _long(df: DataFrame, section: str, rows: list[dict[str, str]]) -> DataFrame:
    """Unpivot columns of `df` into briefing rows; cells are SQL expressions."""
    structs = [
        "struct(" + ", ".join(f"CAST({r.get(k, 'NULL')} AS {t}) AS {k}" for k, t in _SHAPE.items()) + ")"
        for r in rows
    ]
    return df.selectExpr(f"'{section}' AS section", f"inline(array({', '.join(structs)}))")


def _count(name: str, column: str, of: str | None = None, **more: str) -> dict[str, str]:
    """One number; with `of` also its denominator and the ratio."""
    row = {"metric": f"'{name}'", "numerator": column, **more}
    if of is not None:
        row |= {"denominator": of, "value": f"try_divide(CAST({column} AS DOUBLE), {of})"}
    return row


def briefing_metrics(
    run: DataFrame, health: DataFrame, hourly: DataFrame, bands: DataFrame,
    capabilities: DataFrame, evidence: DataFrame, rnr: DataFrame, load: DataFrame,
    resolution: DataFrame, commissioning: DataFrame, recent: int = C.RECENT_RUNS,
) -> DataFrame:
    """Every briefing number as (section, metric, run_id, numerator, denominator, value, label)."""
    zero = lambda n: f"coalesce({n}, 0)"
    counts = (*C.ATTEMPT_STATES, C.COMMISSIONING, "discovered_series_attempts", "expected_slots")
    shares = ("populated_frequencies", "sampled_empty_frequencies", "regulatory_skips", "capture_errors")
    per_run = ("observed_bssids", "beacon_frames", "sampled_frequencies", "sampled_empty_frequencies")
    parts = [
        _long(markers(run, health, hourly), _SCOPE, [{"metric": "marker", "label": "text"}]),
        _long(H.health_totals(health), _HEALTH, [_count(n, n) for n in counts]),
        _long(derivation_counts(run), _HEALTH, [
            _count("derivation_status", "runs", label="extraction_status")]),
        _long(coverage_totals(bands), _COVERAGE, [
            *[_count(n, n, "attempted_frequencies", label="band") for n in shares],
            *[_count(n, n, label="band") for n in ("observed_bssids", "beacon_frames")]]),
        _long(snapshot(hourly), _SNAPSHOT, [
            {"metric": f"measure || '_{s}'", "value": s, "denominator": "trend_runs"}
            for s in ("latest", "lowest", "median", "highest")]),
        _long(omitted_runs(hourly, recent), _SNAPSHOT, [_count("omitted_runs", "omitted", "trend_runs")]),
        _long(recent_runs(hourly, recent), _SNAPSHOT, [
            *[_count(n, n, run_id="run_id") for n in per_run],
            {"metric": "'mean_rssi_dbm'", "run_id": "run_id", "value": "mean_rssi_dbm"}]),
        _long(capability_totals(capabilities), _CAPABILITY, [
            _count(n, zero(n), zero("observed_bssids")) for n in _CAPABILITIES]),
        _long(latest_row(capabilities), _CAPABILITY, [
            _count(f"latest_{n}", n, "observed_bssids", run_id="run_id") for n in _LATEST_CAPABILITIES]),
        _long(evidence_totals(evidence), _SIX, [_count(n, zero(n)) for n in _EVIDENCE]),
        _long(latest_row(evidence), _SIX, [_count(f"latest_{n}", n, run_id="run_id") for n in _EVIDENCE]),
        _long(load_summary(load), _LOAD, [
            *[_count(n, n) for n in ("frames", "bssids", "runs", "stations_min", "stations_max")],
            *[_count(n, n, "255") for n in ("utilization_min", "utilization_max")]]),
        _long(findings(run, health, rnr, resolution), _QUALITY, [
            {"metric": "finding", "numerator": "n", "label": "concat_ws(' ', subject, detail)"}]),
        _long(commissioning, _COMMISSIONING, [
            _count("present", "CAST(present AS INT)", run_id="run_id"),
            *[_count(n, n, run_id="run_id") for n in ("frequencies", "sampled", "observations", "bssids")]]),
    ]
    return reduce(DataFrame.unionByName, parts)


def provenance(spark: SparkSession, series: SeriesConfig, root: str, derived_root: str) -> DataFrame:
    """Briefing rows of what the numbers were made from: series boundary, versions, roots and views."""
    facts = [
        (_SCOPE, "series_start", series.series_start),
        *[(_SCOPE, "commissioning_run", r) for r in series.commissioning],
        (_PROVENANCE, "derived_schema_id", series.derived_schema_id),
        (_PROVENANCE, "extractor_version", series.extractor_version),
        (_PROVENANCE, "source_root", root), (_PROVENANCE, "derived_root", derived_root),
        *[(_PROVENANCE, "view", v) for v in C.VIEW_NAMES],
    ]
    rows = spark.createDataFrame(facts, "section string, metric string, label string")
    return rows.select("section", *[
        F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in _SHAPE.items()
    ])


def in_section_order(briefing: DataFrame) -> DataFrame:
    """Briefing rows in section order."""
    position = F.array_position(F.array(*[F.lit(s) for s in C.BRIEFING_SECTIONS]), F.col("section"))
    return briefing.orderBy(position, "metric", "run_id", radio.band_rank(F.col("label")), "label")

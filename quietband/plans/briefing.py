"""Published views to briefing numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quietband.config import SeriesConfig
from quietband.operators import briefing as B
from quietband.plans import tree
from quietband.session import run_together, scratch_path
from quietband.sources.survey_files import read_commissioning


# Views with one row per run, or per run and band: small, and read by several sections each.
RUN_GRAIN = ("pilot_run_health", "pilot_hourly_metrics", "pilot_band_metrics",
             "pilot_capability_metrics", "pilot_6ghz_evidence")


def store_run_grain(spark: SparkSession, views: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The views with the run-grain ones stored, so each fact table is scanned once per view."""
    base = scratch_path(spark, "briefing")
    run_together(
        [lambda n=n: views[n].write.parquet(f"{base}/{n}") for n in RUN_GRAIN]
    )
    stored = {n: spark.read.schema(views[n].schema).parquet(f"{base}/{n}") for n in RUN_GRAIN}
    return {**views, **stored}


def briefing_from_views(views: dict[str, DataFrame], commissioning: DataFrame) -> DataFrame:
    return B.briefing_metrics(
        run=views["pilot_runs"], health=views["pilot_run_health"],
        hourly=views["pilot_hourly_metrics"], bands=views["pilot_band_metrics"],
        capabilities=views["pilot_capability_metrics"], evidence=views["pilot_6ghz_evidence"],
        rnr=views["pilot_rnr"], load=views["pilot_bss_load"],
        resolution=views["pilot_field_resolution"], commissioning=commissioning,
    )


def briefing(
    spark: SparkSession, root: str, derived_root: str, views: dict[str, DataFrame], series: SeriesConfig
) -> DataFrame:
    """All ten sections in order.  Commissioning runs come from their source tables."""
    frequencies, observations = read_commissioning(
        tree.frequencies(spark, root), tree.observations(spark, root), series.commissioning
    )
    summary = B.commissioning_summary(frequencies, observations, series.commissioning)
    return whole_briefing(spark, store_run_grain(spark, views), summary, series, root, derived_root)


def whole_briefing(
    spark: SparkSession, views: dict[str, DataFrame], commissioning: DataFrame, series: SeriesConfig,
    root: str, derived_root: str,
) -> DataFrame:
    made_from = B.provenance(spark, series, root, derived_root)
    return B.in_section_order(briefing_from_views(views, commissioning).unionByName(made_from))

"""Derived tables and run tree to the twelve published views."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from quietband import schemas
from quietband.config import SeriesConfig
from quietband.operators import health as H
from quietband.operators import incremental as I
from quietband.operators import metrics as M
from quietband.plans import tree
from quietband.sources import derived as D
from quietband.sources.exports import publish_views


def base_view(rows: DataFrame, table: str) -> DataFrame:
    """A derived table at source grain, in contract column order."""
    return rows.select(*schemas.DERIVED[table].fieldNames())


#: View -> how it is made of the gated tables and run health; a view asks for no table but its own.
VIEWS: dict[str, Callable[[Mapping[str, DataFrame], DataFrame], DataFrame]] = {
    "pilot_runs": lambda t, health: base_view(t["run"], "run"),
    "pilot_frequencies": lambda t, health: base_view(t["frequencies"], "frequencies"),
    "pilot_observations": lambda t, health: base_view(t["observations"], "observations"),
    "pilot_ie_capabilities": lambda t, health: base_view(t["ie_capabilities"], "ie_capabilities"),
    "pilot_rnr": lambda t, health: base_view(t["rnr"], "rnr"),
    "pilot_bss_load": lambda t, health: base_view(t["bss_load"], "bss_load"),
    "pilot_field_resolution": lambda t, health: base_view(t["field_resolution"], "field_resolution"),
    "pilot_run_health": lambda t, health: H.run_health_view(health, t["run"]),
    "pilot_hourly_metrics": lambda t, health: M.hourly_metrics(t["frequencies"], t["observations"], health),
    "pilot_band_metrics": lambda t, health: M.band_metrics(t["frequencies"], t["observations"], health),
    "pilot_capability_metrics": lambda t, health: M.capability_metrics(t["ie_capabilities"], health),
    "pilot_6ghz_evidence": lambda t, health: M.evidence_6ghz(t["frequencies"], t["observations"], t["rnr"], health),
}


def assemble_views(tables: Mapping[str, DataFrame], health: DataFrame) -> dict[str, DataFrame]:
    """The twelve views over gated tables and run health."""
    return {name: make(tables, health) for name, make in VIEWS.items()}


def build_views(
    spark: SparkSession, root: str, derived_root: str, now: datetime, series: SeriesConfig,
    verify: bool = True, reread: bool = False,
) -> dict[str, DataFrame]:
    """Check that tree, manifests and tables agree, then publish the views.

    Part files whose digest is known, by name, size and time of change, are not read again unless `reread` asks for it.
    """
    classified = tree.classified(spark, root, series)
    manifests = D.read_manifest_table(spark, derived_root)
    if verify:
        I.require_reconciled(classified, manifests, f"{derived_root}/reports/unreconciled")
        I.require_intact(
            I.damaged_outputs(
                I.recorded_outputs(manifests), D.recorded_batch_digests(spark, derived_root, manifests, reread)
            ),
            f"{derived_root}/reports/damaged",
        )
    health = H.build_run_health(classified, H.expected_slots(H.clock(spark, now), series))
    views = assemble_views(D.read_derived(spark, derived_root), health)
    publish_views(spark, views)
    return views

"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from quietband.session import build_session
from verification.catalog import QUERIES, wire_captures
from verification.inputs import Inputs

HEADLINE = (
    "a7_capture_decode",
    "c11_rnr_records",
    "c14_bss_load_records",
    "d6_advertised_not_observed",
    "d9_neighbor_outcomes",
    "e1_beacon_summary",
    "e7_hourly_metrics",
    "e8_band_metrics",
    "e9_capability_metrics",
    "e14_6ghz_evidence",
    "e15_ie_capabilities",
    "e17_health_totals",
    "e22_reception_bounds",
    "e24_radio_families",
    "e30_multi_frequency",
    "e33_element_census",
    "p1_plan_update",
    "p4_briefing_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("sum(id)").collect()

    inputs = Inputs(spark, sf_dir)
    seconds: dict[str, float] = {}
    # Mapping the given tables onto the survey layout is timed on its own.
    start = time.perf_counter()
    for name in ("runs", "captures", "frames"):
        getattr(inputs, name)
    for name in ("frequencies", "observations", "ie_capabilities", "rnr", "bss_load", "field_resolution"):
        inputs.derived_table(name)
    wire_captures(inputs)
    prepare = round(time.perf_counter() - start, 3)

    for key in HEADLINE:
        start = time.perf_counter()
        QUERIES[key](inputs).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "prepare_seconds": prepare, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

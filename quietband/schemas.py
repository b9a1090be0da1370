"""Declared schemas.  Nothing in this package infers a type from data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quietband.config import CAPABILITY_COLUMNS, RADIOTAP_PROBE, RNR_CELLS


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "array<int>": T.ArrayType(T.IntegerType()),
    "array<string>": T.ArrayType(T.StringType()),
}


def _struct(columns: str, **nested: T.DataType) -> T.StructType:
    """A schema from ``name type`` pairs; a type named in `nested` is that type."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(n, nested.get(t) or _TYPES[t]) for n, t in pairs])


RUN = _struct(
    "run_id string, source_path string, classification string, attempt_state string, "
    "run_status string, started_utc string, eligible boolean, input_complete boolean, "
    "extraction_status string, error string, derived_schema_id string, "
    "extractor_version string, tshark_version string"
)
FREQUENCIES = _struct(
    "run_id string, band string, frequency_mhz bigint, channel bigint, "
    "regulatory_state string, sample_status string, dwell_seconds bigint, "
    "pcap_file string, bssid_count bigint, beacon_count bigint, error string"
)
OBSERVATIONS = _struct(
    "run_id string, band string, frequency_mhz bigint, channel bigint, bssid string, "
    "ssid string, beacons bigint, beacon_interval_tu bigint, rssi_min_dbm bigint, "
    "rssi_mean_dbm double, rssi_max_dbm bigint, first_seen string, last_seen string, "
    "beacon_reception_ratio double"
)
IE_CAPABILITIES = _struct(
    "run_id string, bssid string, elements string, ext_elements string, "
    + ", ".join(f"{c} boolean" for c in CAPABILITY_COLUMNS)
)
RNR = _struct(
    "run_id string, pcap_file string, frame_number bigint, frame_time_epoch string, "
    "tx_bssid string, tx_ssid string, "
    + ", ".join(f"{c} string" for c in RNR_CELLS.values())
    + ", target_band string, target_frequency_mhz bigint, structure_status string, "
    "unpaired_fields string, field_resolution_state string, "
    + ", ".join(f"raw_{c} string" for c in RNR_CELLS.values())
)
BSS_LOAD = _struct(
    "run_id string, pcap_file string, frame_number bigint, frame_time_epoch string, "
    "bssid string, ssid string, station_count bigint, utilization bigint, "
    "admission_capacity bigint, raw_station_count string, raw_utilization string, "
    "raw_admission_capacity string"
)
FIELD_RESOLUTION = _struct(
    "run_id string, logical_name string, status string, resolved_field string, "
    "candidates string"
)
RUN_HEALTH = _struct(
    "run_id string, state string, eligible boolean, in_trend boolean, reason string, "
    "started_utc string, input_complete boolean"
)

DERIVED = {
    "run": RUN,
    "frequencies": FREQUENCIES,
    "observations": OBSERVATIONS,
    "ie_capabilities": IE_CAPABILITIES,
    "rnr": RNR,
    "bss_load": BSS_LOAD,
    "field_resolution": FIELD_RESOLUTION,
}

INSTRUMENT = _struct(
    "schema string, run_status string, skip_reason string, started_utc string, "
    "interface string, interface_present boolean, phy string, regulatory_domain string, "
    "regulatory_domain_phy string, usb usb, capture capture",
    usb=_struct(
        "bus string, port string, device string, controller_pci string, "
        "speed_mbps string, driver string"
    ),
    capture=_struct("dwell_seconds int, bands string, snaplen int, bpf_filter string"),
)

MANIFEST = _struct(
    "schema_id string, derived_version string, extractor_version string, "
    "tshark_version string, run_id string, source_path string, "
    "classification classification, status string, errors array<string>, "
    "source_files files, outputs outputs, manifest_written_utc string",
    classification=_struct(
        "membership string, attempt_state string, run_status string, started_utc string, "
        "eligible boolean, input_complete boolean"
    ),
    files=T.ArrayType(_struct("name string, size bigint, sha256 string")),
    outputs=T.ArrayType(_struct("name string, rows bigint, sha256 string")),
)

# One row per decoded beacon, or one row carrying `error` for a capture that is unreadable.
FRAMES = _struct(
    "run_id string, pcap_file string, frame_number bigint, frame_time_epoch string, "
    "captured_length bigint, wire_length bigint, bssid string, ssid_hex string, "
    "ssid_text string, interval_tu bigint, beacon_timestamp string, rssi_dbm bigint, tags array<int>, exts array<int>, "
    + ", ".join(f"{c} array<string>" for c in RNR_CELLS)
    + ", qbss_station_count array<string>, qbss_utilization array<string>, "
    "qbss_admission array<string>, he_bss_color array<string>, "
    + ", ".join(f"{c} array<string>" for c in RADIOTAP_PROBE)
    + ", error string"
)


STORED_COLUMNS = _struct("batch string, run_date string")


def empty(spark: SparkSession, table: str) -> DataFrame:
    """A typed, empty relation for a derived table that no run contributes to."""
    return spark.createDataFrame([], DERIVED[table])


def union_layers(parts: list[DataFrame], schema: T.StructType) -> DataFrame:
    """One table from runs or batches of several ages: columns that an older part lacks are typed NULL."""
    whole = [
        part.select(*[
            (F.col(f.name) if f.name in part.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
        ])
        for part in parts
    ]
    return reduce(DataFrame.unionByName, whole)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project `df` onto a declared schema: same columns, order and types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])

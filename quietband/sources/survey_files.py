"""Run-tree sources: text tables, instrument records, manifests and the run registry.

A run tree is ``<root>/<run_id>/<file>``; a ``run_id=`` directory prefix is accepted too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quietband import schemas
from quietband.functions import radio, times
from quietband.functions.cells import double_cell, is_bad_cell, long_cell, text_cell

# The columns of the two source tables, in file order.
FREQUENCY_COLUMNS = (
    "band", "frequency_mhz", "channel", "regulatory_state", "sample_status",
    "dwell_seconds", "pcap_file", "bssid_count", "beacon_count", "error",
)
AGGREGATE_COLUMNS = (
    "band", "frequency_mhz", "channel", "bssid", "ssid", "beacons", "beacon_interval_tu",
    "rssi_min_dbm", "rssi_mean_dbm", "rssi_max_dbm", "first_seen", "last_seen",
    "beacon_reception_ratio",
)


def path_run_id(path: Column) -> Column:
    return F.regexp_extract(path, r"(?:^|/)(?:run_id=)?([^/]+)/[^/]+$", 1)


def path_file(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def _text_table(spark: SparkSession, paths, columns: tuple[str, ...]) -> DataFrame:
    # No quoting and no escapes: an SSID may start with a quote character.
    return (
        spark.read.schema(", ".join(f"{c} string" for c in columns))
        .options(sep="\t", header=True, quote="", escape="", enforceSchema=True, mode="PERMISSIVE")
        .csv(paths)
        .select(path_run_id(F.col("_metadata.file_path")).alias("run_id"), *columns)
    )


def _typed(raw: DataFrame, schema, lowered: tuple[str, ...] = ()) -> tuple[DataFrame, Column]:
    """Parse every text cell to its declared type; also the any-cell-is-bad condition."""
    columns, bad = [], F.lit(False)
    for field in schema:
        kind = field.dataType.simpleString()
        cell = F.col(field.name)
        if field.name == "run_id":
            value = cell
        elif kind == "string":
            value = F.lower(text_cell(cell)) if field.name in lowered else text_cell(cell)
        else:
            value = long_cell(cell) if kind == "bigint" else double_cell(cell)
            bad = bad | is_bad_cell(cell, value)
        columns.append(value.alias(field.name))
    return raw.select(*columns, bad.alias("bad_cell")), bad


def read_frequencies(spark: SparkSession, paths) -> DataFrame:
    """One row per manifest row, empties and skips included, plus a ``bad_cell`` flag."""
    return _typed(_text_table(spark, paths, FREQUENCY_COLUMNS), schemas.FREQUENCIES)[0]


def read_observations(spark: SparkSession, paths) -> DataFrame:
    """One row per source row; addresses lower-cased, nothing consolidated."""
    raw = _text_table(spark, paths, AGGREGATE_COLUMNS)
    return _typed(raw, schemas.OBSERVATIONS, ("bssid",))[0]


def read_sweeps(spark: SparkSession, frequency_paths, aggregate_paths) -> tuple[DataFrame, DataFrame]:
    """Typed load for profiling: adds parsed ``first_seen_ts`` and ``last_seen_ts``."""
    freq = read_frequencies(spark, frequency_paths)
    agg = read_observations(spark, aggregate_paths)
    parsed = agg.withColumns(
        {
            f"{c}_ts": F.timestamp_micros(times.stamp_micros(F.col(c)))
            for c in ("first_seen", "last_seen")
        }
    )
    return freq, parsed


def read_instruments(spark: SparkSession, paths) -> DataFrame:
    """Instrument records with ``instrument_ok``; an unreadable document keeps its row."""
    raw = spark.read.option("wholetext", True).text(paths)
    return parse_instruments(
        raw.select(path_run_id(F.col("_metadata.file_path")).alias("run_id"), F.col("value").alias("document"))
    )


def parse_instruments(documents: DataFrame) -> DataFrame:
    """(run_id, document) to (run_id, instrument_ok, run_status, started_utc, instrument)."""
    # A truncated or non-object document has no parseable VARIANT object at all.
    shape = F.schema_of_variant(F.try_parse_json(F.col("document")))
    ok = F.coalesce(shape.startswith("OBJECT"), F.lit(False))
    parsed = F.when(ok, F.from_json("document", schemas.INSTRUMENT))
    return documents.select(
        "run_id", ok.alias("instrument_ok"), parsed.alias("instrument")
    ).select(
        "run_id", "instrument_ok",
        F.col("instrument.run_status").alias("run_status"),
        F.col("instrument.started_utc").alias("started_utc"), "instrument",
    )


def _lines(spark: SparkSession, paths) -> DataFrame:
    """Text lines with their run, file and an orderable position inside that file."""
    return spark.read.text(paths).select(
        path_run_id(F.col("_metadata.file_path")).alias("run_id"),
        path_file(F.col("_metadata.file_path")).alias("file"),
        # Rows of one split are read in order; splits of one file are ordered by offset.
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("line_no"),
        F.col("value").alias("line"),
    )


def read_text_headers(spark: SparkSession, paths) -> DataFrame:
    """(run_id, file, readable): whether each file's first line carries text."""
    opening = _lines(spark, paths).where(F.col("line_no.block") == 0)
    return (
        opening.groupBy("run_id", "file")
        .agg(F.min_by("line", "line_no").alias("header"))
        .select("run_id", "file", (F.trim("header") != "").alias("readable"))
    )


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any file matches a glob pattern."""
    jvm = spark.sparkContext._jvm
    glob = jvm.org.apache.hadoop.fs.Path(pattern)
    found = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob)
    return found is not None and len(found) > 0


def assemble_registry(registry: DataFrame, instruments: DataFrame, headers: DataFrame) -> DataFrame:
    """Join file evidence to the registry, one row per child of the tree."""
    evidence = headers.groupBy("run_id").agg(
        F.bool_or((F.col("file") == "frequencies.tsv") & F.col("readable")).alias("frequencies_ok"),
        F.bool_or((F.col("file") == "aggregate.tsv") & F.col("readable")).alias("aggregate_ok"),
        *[F.bool_or(F.col("file") == f"{t}.tsv").alias(f"{t}_found") for t in ("frequencies", "aggregate")],
    )
    return (
        registry.join(instruments.withColumnRenamed("run_id", "name").drop("instrument"), "name", "left")
        .join(evidence.withColumnRenamed("run_id", "name"), "name", "left")
        .select(
            "name", "path", "is_dir",
            *[
                F.coalesce(F.col(c), F.lit(False)).alias(c)
                for c in ("instrument_ok", "frequencies_ok", "aggregate_ok", "frequencies_found", "aggregate_found")
            ],
            "run_status", "started_utc",
        )
    )


def read_manifests(spark: SparkSession, paths) -> DataFrame:
    """Derivation manifests written one JSON document per file; unreadable ones are absent."""
    raw = spark.read.option("wholetext", True).text(paths)
    return parse_manifests(raw.select(F.col("value").alias("document")))


def parse_manifests(documents: DataFrame) -> DataFrame:
    shape = F.schema_of_variant(F.try_parse_json(F.col("document")))
    return (
        documents.where(shape.startswith("OBJECT"))
        .select(F.from_json("document", schemas.MANIFEST).alias("m"))
        .select("m.*")
    )


def phy_frequency_table(lines: DataFrame, bands: tuple[str, ...]) -> DataFrame:
    """Listed frequencies per run: the first line naming a frequency wins."""
    pattern = r"^\s*\*\s+([0-9]+(?:\.[0-9]+)?)\s+MHz\s+\[([0-9]+)\]\s*(.*)$"
    field = lambda n: F.regexp_extract("line", pattern, n)
    listed = lines.where(F.col("line").rlike(pattern)).select(
        "run_id", "line_no",
        F.bround(field(1).cast("decimal(20,6)"), 0).cast("bigint").alias("frequency_mhz"),
        field(2).cast("bigint").alias("channel"),
        radio.regulatory_state(field(3)).alias("regulatory_state"),
    )
    first = listed.groupBy("run_id", "frequency_mhz").agg(
        F.min_by(F.struct("channel", "regulatory_state"), "line_no").alias("first")
    )
    band = radio.band_of_frequency(F.col("frequency_mhz"))
    return first.where(band.isin(*bands)).select(
        "run_id", band.alias("band"), "frequency_mhz", "first.channel", "first.regulatory_state"
    )


def read_commissioning(frequencies: DataFrame, observations: DataFrame, runs: tuple[str, ...]):
    """The two source tables restricted to the commissioning runs (a partition filter)."""
    keep = F.col("run_id").isin(*runs)
    return frequencies.where(keep), observations.where(keep)

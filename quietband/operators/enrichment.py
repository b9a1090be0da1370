"""Beacon frames to the advanced tables, extraction status and field resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietband import config as C
from quietband import schemas
from quietband.config import SeriesConfig
from quietband.functions import names, radio
from quietband.functions.cells import bit_text, bit_words, filled, first_of, joined, set_names
from quietband.functions.times import iso_stamp

_IDENTITY = ("frame_number", "frame_time_epoch", "bssid")
STANDARD, EXTENSION = "element", "extension"
_EXTENSION_OFFSET = 256


# --- Packet identity --------------------------------------------------------------------

def identity_errors(frames: DataFrame) -> DataFrame:
    """(run_id, error) of runs holding an unreadable capture or a frame without identity.

    The first affected capture names the error; one run row results, however many frames fail.
    """
    blank = F.lit(False)
    for name in _IDENTITY:
        blank = blank | filled(F.col(name).cast("string")).isNull()
    problem = F.coalesce(
        F.col("error"),
        F.when(blank, F.concat("pcap_file", F.lit(": beacon row missing packet identity"))),
    )
    return (
        frames.select("run_id", "pcap_file", problem.alias("problem"))
        .where(F.col("problem").isNotNull())
        .groupBy("run_id")
        .agg(F.min_by("problem", F.struct("pcap_file", "problem")).alias("error"))
    )


def identified_frames(frames: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Frames of runs whose every frame has identity; a bad run contributes no row at all.

    `errors` are the frames' identity_errors where they are stored: their size is known then, and few of them need no shuffle
    of the frames, which are the widest rows there are.
    """
    errors = identity_errors(frames) if errors is None else errors
    return frames.where(F.col("error").isNull()).join(errors.select("run_id"), "run_id", "left_anti")


# --- Elements ---------------------------------------------------------------------------

def element_counts(frames: DataFrame) -> DataFrame:
    """Frames per (run, address, namespace, element); a frame counts an element once.

    An address that sent no element keeps one row with a NULL element.  Both namespaces share
    one integer key, extensions offset by 256, so a frame explodes into plain integers.
    """
    none = F.array().cast("array<int>")
    tags, exts = (F.array_distinct(F.coalesce(F.col(c), none)) for c in ("tags", "exts"))
    codes = F.concat(tags, F.transform(exts, lambda e: e + _EXTENSION_OFFSET))
    counted = (
        frames.select("run_id", F.lower("bssid").alias("bssid"), F.explode_outer(codes).alias("code"))
        .groupBy("run_id", "bssid", "code")
        .agg(F.count("*").alias("frames"))
    )
    extension = F.col("code") >= _EXTENSION_OFFSET
    return counted.select(
        "run_id", "bssid",
        F.when(extension, EXTENSION).when(F.col("code").isNotNull(), STANDARD).alias("namespace"),
        F.when(extension, F.col("code") - _EXTENSION_OFFSET).otherwise(F.col("code")).alias("element"),
        "frames",
    )


def ie_capabilities(frames: DataFrame) -> DataFrame:
    """One capability row per run and address.

    Element ids are one byte each, so an address's set is four 64-bit words per namespace: frames are aggregated as they are, by
    hashing, without a row per element.
    """
    words = {f"{c}{k}": word for c in ("tags", "exts") for k, word in enumerate(bit_words(F.col(c)))}
    united = frames.select("run_id", F.lower("bssid").alias("bssid"), *[w.alias(n) for n, w in words.items()]).groupBy(
        "run_id", "bssid"
    ).agg(*[F.bit_or(n).alias(n) for n in words])
    tags, exts = ([F.col(n) for n in words if n.startswith(c)] for c in ("tags", "exts"))
    flags = radio.capability_flags(tags, exts)
    return schemas.conform(
        united.select(
            "run_id", "bssid", bit_text(tags).alias("elements"), bit_text(exts).alias("ext_elements"),
            *[flag.alias(name) for name, flag in flags.items()],
        ),
        schemas.IE_CAPABILITIES,
    )


# --- Neighbor reports -------------------------------------------------------------------

def unpaired_cells(cells: dict[str, Column]) -> Column:
    """Logical names of repeated cells, comma-joined; NULL when none repeats."""
    return F.nullif(
        F.array_join(set_names([(F.size(c) > 1, name) for name, c in cells.items()]), ","),
        F.lit(""),
    )


def rnr_records(frames: DataFrame, resolved: tuple[str, ...] = tuple(C.RNR_CELLS)) -> DataFrame:
    """One row per frame carrying a neighbor report.

    Scalar cells hold the first occurrence and ``raw_*`` the verbatim cell.  Nothing is
    paired by position: a target is stated only where every cell occurs once.
    """
    used = [name for name in C.RNR_CELLS if name in resolved]
    no_cell = F.lit(None).cast("array<string>")
    cells = {name: F.col(name) if name in used else no_cell for name in C.RNR_CELLS}
    scalars = {
        column: first_of(cells[name]) for name, column in C.RNR_CELLS.items()
    }
    scalars["neighbor_bssid"] = radio.canonical_mac(scalars["neighbor_bssid"])
    base = frames.where(F.array_contains("tags", C.TAG_RNR)).select(
        "run_id", "pcap_file", "frame_number", "frame_time_epoch",
        F.lower("bssid").alias("tx_bssid"),
        names.decode_ssid(F.col("ssid_hex")).alias("tx_ssid"),
        *[value.alias(column) for column, value in scalars.items()],
        *[joined(cells[name]).alias(f"raw_{column}") for name, column in C.RNR_CELLS.items()],
        unpaired_cells({name: cells[name] for name in used}).alias("unpaired_fields"),
        F.lit("resolved" if used else "unresolved_candidates").alias("field_resolution_state"),
    )
    return schemas.conform(target_gate(base), schemas.RNR)


def target_gate(records: DataFrame) -> DataFrame:
    """Add structure status and, where the pairing is certain, target band and frequency."""
    single = F.col("unpaired_fields").isNull()
    digits = F.col("op_class").rlike("^[0-9]+$") & F.col("channel").rlike("^[0-9]+$")
    op, channel = (F.col(c).try_cast("bigint") for c in ("op_class", "channel"))
    sure = single & digits
    return records.withColumns(
        {
            "structure_status": F.when(single, C.SINGLE).otherwise(C.MULTI),
            "target_band": F.when(sure, radio.opclass_band(op)),
            "target_frequency_mhz": F.when(sure, radio.opclass_mhz(op, channel)),
        }
    )


# --- BSS Load ---------------------------------------------------------------------------

def bss_load_records(frames: DataFrame) -> DataFrame:
    """One row per frame carrying a BSS Load element."""
    return schemas.conform(
        frames.where(F.array_contains("tags", C.TAG_BSS_LOAD)).select(
            "run_id", "pcap_file", "frame_number", "frame_time_epoch",
            F.lower("bssid").alias("bssid"),
            names.decode_ssid(F.col("ssid_hex")).alias("ssid"),
            *[first_of(F.col(n)).try_cast("bigint").alias(c) for n, c in C.LOAD_CELLS.items()],
            *[joined(F.col(n)).alias(f"raw_{c}") for n, c in C.LOAD_CELLS.items()],
        ),
        schemas.BSS_LOAD,
    )


# --- Summary of decoded beacons -----------------------------------------------------------

def beacon_summary(frames: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Observations per (run, frequency, address) from decoded frames.

    Name and interval are the last non-empty ones in frame order.  The frequency is in the
    capture's name; channel and dwell come from the manifest, joined after the frames are
    aggregated, and stay empty where it has no row for a capture. Captures with an error count for nothing.
    """
    order = F.col("frame_number")
    last = lambda value, keep: F.max_by(value, F.when(keep, order))
    broken = frames.where(F.col("error").isNotNull()).select("run_id", "pcap_file").distinct()
    heard = (
        frames.where(F.col("error").isNull()).join(broken, ["run_id", "pcap_file"], "left_anti")
        .groupBy("run_id", "pcap_file", F.lower("bssid").alias("bssid"))
        .agg(
            F.count("*").alias("beacons"),
            F.coalesce(last(F.col("ssid_text"), F.col("ssid_text") != ""), F.lit("")).alias("ssid"),
            last(F.col("interval_tu"), F.col("interval_tu") != 0).alias("beacon_interval_tu"),
            F.min("rssi_dbm").alias("rssi_min_dbm"),
            F.bround(F.avg("rssi_dbm"), 1).alias("rssi_mean_dbm"),
            F.max("rssi_dbm").alias("rssi_max_dbm"),
            F.min_by("frame_time_epoch", order).alias("first_epoch"),
            F.max_by("frame_time_epoch", order).alias("last_epoch"),
        )
    )
    tuned = frequencies.where(F.col("pcap_file") != "").groupBy("run_id", "pcap_file").agg(
        F.min(F.struct("frequency_mhz", "channel", "dwell_seconds")).alias("t")
    )
    named = F.regexp_extract("pcap_file", "freq-([0-9]+)", 1).try_cast("bigint")
    mhz = F.coalesce(named, F.col("t.frequency_mhz"))
    return schemas.conform(
        heard.join(tuned, ["run_id", "pcap_file"], "left").select(
            "run_id", radio.band_of_frequency(mhz).alias("band"), mhz.alias("frequency_mhz"),
            F.col("t.channel").alias("channel"), "bssid", "ssid", "beacons", "beacon_interval_tu",
            "rssi_min_dbm", "rssi_mean_dbm", "rssi_max_dbm",
            iso_stamp(F.col("first_epoch")).alias("first_seen"),
            iso_stamp(F.col("last_epoch")).alias("last_seen"),
            radio.reception_ratio(
                F.col("beacons"), F.col("t.dwell_seconds"), F.col("beacon_interval_tu")
            ).alias("beacon_reception_ratio"),
        ),
        schemas.OBSERVATIONS,
    )


# --- Field resolution -------------------------------------------------------------------

def resolve_fields(runs: DataFrame, available: DataFrame) -> DataFrame:
    """Per run and logical field: the first candidate the run's dissector offers.

    ``available`` is (run_id, field).  The candidate list is the fixed one of ``config``.
    """
    wanted = F.array(
        *[
            F.struct(
                F.lit(logical).alias("logical_name"),
                F.array(*[F.lit(c) for c in candidates]).alias("choices"),
            )
            for logical, candidates in C.FIELD_CANDIDATES.items()
        ]
    )
    rank = F.create_map(
        *[
            F.lit(part)
            for candidates in C.FIELD_CANDIDATES.values()
            for position, field in enumerate(candidates)
            for part in (field, position)
        ]
    )
    owner = F.create_map(
        *[
            F.lit(part)
            for logical, candidates in C.FIELD_CANDIDATES.items()
            for field in candidates
            for part in (field, logical)
        ]
    )
    hits = (
        available.select(
            "run_id", "field",
            F.try_element_at(owner, F.col("field")).alias("logical_name"),
            F.try_element_at(rank, F.col("field")).alias("rank"),
        )
        .where(F.col("logical_name").isNotNull())
        .groupBy("run_id", "logical_name")
        .agg(F.min_by("field", "rank").alias("resolved_field"))
    )
    return schemas.conform(
        runs.select("run_id", F.explode(wanted).alias("w"))
        .select("run_id", "w.logical_name", F.array_join("w.choices", ",").alias("candidates"))
        .join(hits, ["run_id", "logical_name"], "left")
        .withColumn(
            "status", F.when(F.col("resolved_field").isNull(), "unresolved").otherwise("resolved")
        ),
        schemas.FIELD_RESOLUTION,
    )


def decoder_fields(runs: DataFrame) -> DataFrame:
    """(run_id, field) for the fields the package's own decoder fills."""
    offered = [F.lit(candidates[0]) for candidates in C.FIELD_CANDIDATES.values()]
    return runs.select("run_id", F.explode(F.array(*offered)).alias("field"))


# --- Extraction status --------------------------------------------------------------------

def core_errors(registry: DataFrame, frequencies: DataFrame, observations: DataFrame) -> DataFrame:
    """(run_id, error) of runs whose two source tables are missing, open with a blank line or hold a bad cell."""
    bad = (
        frequencies.select("run_id", "bad_cell")
        .unionByName(observations.select("run_id", "bad_cell"))
        .where("bad_cell").select("run_id", F.lit("unparseable cell").alias("problem"))
    )

    def fault(table: str) -> Column:
        """What keeps a table from being read, given that something does."""
        # Registries without this evidence cannot tell a blank table from an absent one.
        found = F.col(f"{table}_found") if f"{table}_found" in registry.columns else F.lit(False)
        return F.when(found, f"no header in source file: {table}.tsv").otherwise(f"missing source file: {table}.tsv")

    absent = registry.where("is_dir").select(
        F.col("name").alias("run_id"),
        F.when(~F.col("frequencies_ok"), fault("frequencies")).when(~F.col("aggregate_ok"), fault("aggregate")).alias("problem"),
    ).where(F.col("problem").isNotNull())
    return bad.unionByName(absent).groupBy("run_id").agg(F.min("problem").alias("error"))


def extraction_status(runs: DataFrame, core: DataFrame, advanced: DataFrame) -> DataFrame:
    """Core failure is ``failed``, advanced failure ``partial``, otherwise ``succeeded``."""
    return (
        runs.select("run_id")
        .join(core.select("run_id", F.concat(F.lit("core tables: "), "error").alias("c")), "run_id", "left")
        .join(advanced.select("run_id", F.concat(F.lit("advanced tables: "), "error").alias("a")), "run_id", "left")
        .select(
            "run_id",
            F.when(F.col("c").isNotNull(), "failed").when(F.col("a").isNotNull(), "partial")
            .otherwise("succeeded").alias("extraction_status"),
            F.nullif(F.array_join(F.array_compact(F.array("c", "a")), "; "), F.lit("")).alias("error"),
        )
    )


def run_table(classified: DataFrame, status: DataFrame, series: SeriesConfig) -> DataFrame:
    """The run table: classification, extraction status and versions."""
    return schemas.conform(
        classified.join(status, "run_id").select(
            "run_id", F.col("path").alias("source_path"), F.col("membership").alias("classification"),
            "attempt_state", "run_status", "started_utc", "eligible", "input_complete",
            "extraction_status", "error",
            F.lit(series.derived_schema_id).alias("derived_schema_id"),
            F.lit(series.extractor_version).alias("extractor_version"),
            F.lit(series.decoder_version).alias("tshark_version"),
        ),
        schemas.RUN,
    )

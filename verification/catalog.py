"""Every operator as a query on the given tables, most with independent SQL.

Keys start with the operator's id in the blueprint.  A query is a function of ``Inputs``;
its SQL names the relations of ``verification.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietband import config as C
from quietband import schemas
from quietband.functions import cells, names, radio, times
from quietband.operators import briefing as B
from quietband.operators import census as K
from quietband.operators import comparison as X
from quietband.operators import enrichment as E
from quietband.operators import health as H
from quietband.operators import incremental as I
from quietband.operators import membership as M
from quietband.operators import metrics as V
from quietband.operators import profile as P
from quietband.operators import sweep_summary as S
from quietband.plans.briefing import briefing_from_views, store_run_grain, whole_briefing
from quietband.plans.views import base_view
from quietband.sources import captures as CAP
from quietband.sources import derived as D
from quietband.sources import exports as OUT
from quietband.sources import survey_files as SRC
from verification.inputs import Inputs
from verification.mapping import DUCK, EXTS, SERIES, SPARK, SSIDS, TAGS
from verification.oracle import DECODED, colons, raw, with_ctes

Query = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = with_ctes(sql)
        return fn

    return register


def simple(key: str, fn: Query, sql: str | None = None) -> None:
    query(key, sql)(fn)


def cols(schema) -> str:
    return ", ".join(schema.fieldNames())


RUN_ID = SPARK.run_id()

# =========================================================================================
# Sources
# =========================================================================================


def _run_files(i: Inputs, label: str, rows: DataFrame) -> str:
    """Write (run_id, value) text lines, one folder per run; the glob of the files."""
    path = i.scratch(label)
    rows.select("run_id", "value").hint("rebalance", "run_id").write.partitionBy("run_id").text(path)
    return f"{path}/run_id=*/*.txt"


def _written(i: Inputs, rows: DataFrame) -> str:
    """A text table written with one folder per run; the glob of its files."""
    root = i.scratch("sweeps")
    OUT.write_tsv(rows.hint("rebalance", "run_id"), root, by_run=True)
    return f"{root}/run_id=*/*.csv"


def _shouted(i: Inputs) -> DataFrame:
    return i.observations.withColumn("bssid", F.upper("bssid"))


@query("a1_frequency_scan", f"SELECT {cols(schemas.FREQUENCIES)} FROM frequencies")
def a1(i):
    return SRC.read_frequencies(i.spark, _written(i, i.frequencies)).drop("bad_cell")


@query("a2_observation_scan", f"SELECT {cols(schemas.OBSERVATIONS)} FROM observations")
def a2(i):
    return SRC.read_observations(i.spark, _written(i, _shouted(i))).drop("bad_cell")


_MICROS = "epoch_us(strptime({0}, '%Y-%m-%dT%H:%M:%S.%fZ')) AS {0}_us"


@query("a3_sweep_load", "SELECT run_id, bssid, ssid, beacons, rssi_mean_dbm, "
       f"{_MICROS.format('first_seen')}, {_MICROS.format('last_seen')} FROM observations")
def a3(i):
    _, agg = SRC.read_sweeps(i.spark, _written(i, i.frequencies), _written(i, _shouted(i)))
    return agg.select(
        "run_id", "bssid", "ssid", "beacons", "rssi_mean_dbm",
        F.unix_micros("first_seen_ts").alias("first_seen_us"), F.unix_micros("last_seen_ts").alias("last_seen_us"),
    )


@query("a4_instrument_scan", """SELECT run_id, instrument_ok, CASE WHEN instrument_ok THEN run_status END AS run_status,
    CASE WHEN instrument_ok THEN started_utc END AS started_utc, CASE WHEN instrument_ok THEN '1' END AS usb_bus
    FROM runs WHERE document IS NOT NULL""")
def a4(i):
    docs = i.runs.where("document is not null").select("run_id", F.col("document").alias("value"))
    rows = SRC.read_instruments(i.spark, _run_files(i, "instruments", docs))
    return rows.select("run_id", "instrument_ok", "run_status", "started_utc", F.col("instrument.usb.bus").alias("usb_bus"))


simple("a5_inventory", lambda i: i.classified, "SELECT * FROM classified")


@query("a6_header_probe", """SELECT run_id, frequencies_ok AS readable FROM runs""")
def a6(i):
    lines = i.runs.select(
        "run_id", F.when(F.col("frequencies_ok"), "band\tfrequency_mhz").otherwise("  ").alias("value")
    )
    return SRC.read_text_headers(i.spark, _run_files(i, "headers", lines)).drop("file")


def _le(value: str, size: int) -> str:
    """Little-endian hex of an integer expression."""
    octets = ", ".join(f"lpad(hex({value} div {256**k} % 256), 2, '0')" for k in range(size))
    return f"lower(concat({octets}))"


def wire_captures(i: Inputs) -> DataFrame:
    return i.stored_once("wire", lambda: _wire_frames(i))


def _wire_frames(i: Inputs) -> DataFrame:
    """Capture bytes built from every event, at most 64 beacons per capture file."""
    octet = SPARK.byte_text
    op = "CASE k % 6 WHEN 0 THEN 81 WHEN 1 THEN 82 WHEN 2 THEN 115 WHEN 3 THEN 131 WHEN 4 THEN 136 ELSE 200 END"
    ssid = f"CASE WHEN k % 5 = 0 THEN '' WHEN k % 31 = 4 THEN 'fffe41' ELSE lower(hex(encode({SPARK.ssid_of('u')}, 'UTF-8'))) END"
    entry = lambda near, n: (f"'ff' || {SPARK.mac(near, '')} || {_le(n, 4)} || "  # noqa: E731
                             f"{octet('(k * 5) % 128')} || '00' || {octet('k % 3')} || {octet('k % 4')} || "
                             "CASE WHEN k % 8 = 5 THEN '20' ELSE '00' END")
    one, two = entry("(u + k % 3)", "event_id"), entry("(u + 11)", "(event_id + 1)")
    rnr = (f"CASE WHEN k % 7 = 0 THEN 'c924' || '1010' || {octet(op)} || {octet('1 + k % 11')} || {one} || {two} "
           f"ELSE 'c914' || '0010' || {octet(op)} || {octet('1 + k % 11')} || {one} END")
    parts = {0: f"'00' || {octet('CAST(length(hx) / 2 AS INT)')} || hx",
             11: f"'0b05' || {_le('(event_id % 40)', 2)} || {octet('event_id % 256')} || {_le('((event_id * 7) % 1000)', 2)}",
             201: rnr}
    elements = " || ".join(
        f"CASE WHEN {cond} THEN {parts.get(n, chr(39) + f'{n:02x}0100' + chr(39))} ELSE '' END" for n, cond in TAGS.items()
    )
    extensions = " || ".join(f"CASE WHEN {cond} THEN 'ff02{n:02x}00' ELSE '' END" for n, cond in EXTS.items())
    signal = octet("256 - 30 - event_id % 60")
    radiotap = f"CASE WHEN k % 19 = 0 THEN '00000900' || '02000000' || '00' ELSE '00000a00' || '22000000' || '00' || {signal} END"
    interval = "CASE WHEN k % 17 = 0 THEN 0 WHEN k % 7 = 3 THEN 102 ELSE 100 END"
    packets = i.mapped(f"""
        SELECT run_id, pcap_file, event_id,
          {_le('(us div 1000000)', 4)} || {_le('(us % 1000000)', 4)} || {_le('size', 4)} || {_le('(size + 3)', 4)} || packet AS record
        FROM (SELECT *, CAST(length(packet) / 2 AS BIGINT) AS size FROM (
          SELECT *, {radiotap} || '80000000' || 'ffffffffffff' || mac || mac || '0000' || repeat('00', 8) ||
              {_le(interval, 2)} || '1100' || {elements} || {extensions} AS packet
          FROM (SELECT *, {RUN_ID} AS run_id, {SPARK.mac('u', '')} AS mac, {ssid} AS hx,
              'freq-' || CAST({SPARK.mhz} AS STRING) || '-' || CAST(event_id div 64 AS STRING) || '.pcap' AS pcap_file FROM ev)))""")
    header = "d4c3b2a1" + "02000400" + "00000000" * 2 + "00000400" + "7f000000"
    return packets.groupBy("run_id", "pcap_file").agg(
        F.unhex(
            F.concat(
                F.lit(header),
                F.array_join(
                    F.transform(F.array_sort(F.collect_list(F.struct("event_id", "record"))), lambda r: r["record"]), ""
                ),
            )
        ).alias("content")
    ).withColumn("length", F.length("content").cast("bigint"))


_WIRE_OP = "CASE k % 6 WHEN 0 THEN 81 WHEN 1 THEN 82 WHEN 2 THEN 115 WHEN 3 THEN 131 WHEN 4 THEN 136 ELSE 200 END"
_WIRE_CELL = "CASE WHEN k % 4 <> 3 THEN {0} END"
_WIRE_SQL = f"""SELECT run_id, pcap_file, row_number() OVER (PARTITION BY run_id, pcap_file ORDER BY event_id) AS frame_number,
    printf('%d.%06d000', us // 1000000, us % 1000000) AS frame_time_epoch, {DUCK.mac('u')} AS bssid,
    CASE WHEN k % 5 = 0 THEN '<MISSING>' WHEN k % 31 = 4 THEN 'fffe41' ELSE lower(hex(encode({DUCK.ssid_of('u')}))) END AS ssid_hex,
    CAST(CASE WHEN k % 17 = 0 THEN 0 WHEN k % 7 = 3 THEN 102 ELSE 100 END AS BIGINT) AS interval_tu,
    CAST(CASE WHEN k % 19 = 0 THEN NULL ELSE -(30 + event_id % 60) END AS BIGINT) AS rssi_dbm,
    array_to_string({DUCK.ids(TAGS)}, ',') AS tags, array_to_string({DUCK.ids(EXTS)}, ',') AS exts,
    {_WIRE_CELL.format(f"CAST({_WIRE_OP} AS VARCHAR)")} AS op_class,
    {_WIRE_CELL.format("CAST(1 + k % 11 AS VARCHAR)")} AS channel,
    {_WIRE_CELL.format(f"{DUCK.mac('(u + k % 3)', '')} || CASE WHEN k % 7 = 0 THEN ',' || {DUCK.mac('(u + 11)', '')} ELSE '' END")} AS neighbor,
    {_WIRE_CELL.format("printf('0x%08x', event_id) || CASE WHEN k % 7 = 0 THEN ',' || printf('0x%08x', event_id + 1) ELSE '' END")} AS short_ssid,
    {_WIRE_CELL.format("printf('0x%02x', (k * 5) % 128)")} AS bss_params,
    {_WIRE_CELL.format("CAST(k % 3 AS VARCHAR)")} AS mld_id, {_WIRE_CELL.format("CAST(k % 4 AS VARCHAR)")} AS mld_link_id,
    {_WIRE_CELL.format("CASE WHEN k % 8 = 5 THEN 'True' ELSE 'False' END")} AS disabled_link,
    CASE WHEN k % 3 = 0 THEN event_id % 40 || '/' || event_id % 256 || '/' || (event_id * 7) % 1000 END AS bss_load
    FROM (SELECT *, {DUCK.run_id()} AS run_id,
      'freq-' || CAST({DUCK.mhz} AS VARCHAR) || '-' || CAST(event_id // 64 AS VARCHAR) || '.pcap' AS pcap_file FROM ev) w"""


@query("a7_capture_decode", _WIRE_SQL)
def a7(i):
    frames = CAP.decode_captures(wire_captures(i))
    return frames.select(
        "run_id", "pcap_file", "frame_number", "frame_time_epoch", "bssid", "ssid_hex", "interval_tu", "rssi_dbm",
        F.array_join("tags", ",").alias("tags"), F.array_join("exts", ",").alias("exts"),
        *[
            cells.joined(F.col(f"rnr_{n}")).alias(alias)
            for n, alias in (("op_class", "op_class"), ("channel", "channel"), ("bssid", "neighbor"),
                             ("short_ssid", "short_ssid"), ("bss_params", "bss_params"), ("mld_id", "mld_id"),
                             ("mld_link_id", "mld_link_id"), ("disabled_link", "disabled_link"))
        ],
        F.array_join(F.concat("qbss_station_count", "qbss_utilization", "qbss_admission"), "/").alias("bss_load"),
    )


simple("a8_populated_captures", lambda i: CAP.populated(i.captures), "SELECT * FROM captures WHERE length > 24")


def _manifest_rows(i: Inputs, rows: DataFrame) -> DataFrame:
    """Manifests with their observation output and two source files, some tampered with."""
    n = lambda text: F.sha2(F.col(text).cast("string"), 256)
    return rows.select(
        "run_id", "h", "status", "schema_id", "extractor_version", F.lit("b1").alias("derived_version"),
        F.array(
            F.struct(F.lit("aggregate.tsv").alias("name"), F.col("n").alias("size"), n("n").alias("sha256")),
            F.struct(F.lit("frequencies.tsv").alias("name"), F.col("beacons").alias("size"), n("beacons").alias("sha256")),
        ).alias("source_files"),
        F.array(F.struct(F.lit("observations.parquet").alias("name"), F.col("n").alias("rows"), n("n").alias("sha256"))).alias("outputs"),
    )


@query("a9_manifest_scan", """SELECT run_id, status, schema_id, extractor_version, 2 AS n_sources, n AS output_rows
    FROM runs WHERE h % 31 <> 12""")
def a9(i):
    rows = _manifest_rows(i, i.runs)
    text = F.to_json(F.struct(*[c for c in rows.columns if c != "h"]))
    docs = rows.select("run_id", F.when(F.col("h") % 31 == 12, F.substring(text, 1, 30)).otherwise(text).alias("value"))
    manifests = SRC.read_manifests(i.spark, _run_files(i, "manifests", docs))
    return manifests.select(
        "run_id", "status", "schema_id", "extractor_version",
        F.size("source_files").alias("n_sources"), F.col("outputs")[0]["rows"].alias("output_rows"),
    )


_STAGED = (*C.CORE_TABLES, *C.ADVANCED_TABLES)


@query("a10_status_gate", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, run_id, count(*) AS n FROM stg_{t} GROUP BY run_id" for t in _STAGED))
def a10(i):
    parts = [
        i.staged[t].groupBy("run_id").agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "run_id", "n")
        for t in _STAGED
    ]
    return reduce(DataFrame.unionByName, parts)


# Empty as it is, then with what an older batch without the last columns left, then whole.
simple("a11_typed_empty",
       lambda i: schemas.union_layers(
           [schemas.empty(i.spark, "observations"), i.observations.where("coalesce(band, '') <> '6GHz'").drop("beacon_reception_ratio"),
            i.observations.where("band = '6GHz'")], schemas.OBSERVATIONS),
       f"""SELECT {cols(schemas.OBSERVATIONS).replace(", beacon_reception_ratio", "")},
       CASE WHEN band = '6GHz' THEN beacon_reception_ratio END AS beacon_reception_ratio FROM observations""")


@query("a12_commissioning_scan", f"""SELECT {cols(schemas.OBSERVATIONS)} FROM observations
    WHERE run_id IN ('{SERIES.commissioning[0]}', '{SERIES.commissioning[1]}')""")
def a12(i):
    return SRC.read_commissioning(i.frequencies, i.observations, SERIES.commissioning)[1]


_PHY_FLAGS = ("CASE k % 4 WHEN 0 THEN '(30.0 dBm)' WHEN 1 THEN '(12.0 dBm) (no IR)' "
              "WHEN 2 THEN '(disabled)' ELSE '(20.0 dBm) (no IR, x) (radar detection)' END")
_PHY_STATE = "CASE k % 4 WHEN 0 THEN 'permitted' WHEN 1 THEN 'no-ir' WHEN 2 THEN 'disabled' ELSE 'no-IR,-x+radar' END"


@query("a13_phy_frequencies", f"""SELECT run_id, band, frequency_mhz, channel, regulatory_state FROM (
    SELECT {DUCK.run_id()} AS run_id, {DUCK.band} AS band, CAST({DUCK.mhz} AS BIGINT) AS frequency_mhz,
      CAST({DUCK.channel} AS BIGINT) AS channel, {_PHY_STATE} AS regulatory_state,
      row_number() OVER (PARTITION BY {DUCK.run_id()}, {DUCK.mhz} ORDER BY event_id) AS place FROM ev) p
    WHERE place = 1 AND band IN ('2.4GHz', '6GHz')""")
def a13(i):
    lines = i.mapped(f"""SELECT {RUN_ID} AS run_id, event_id AS line_no, CASE WHEN k % 3 = 3 THEN 'Frequencies:'
        ELSE '\\t\\t* ' || CAST({SPARK.mhz} AS STRING) || '.0 MHz [' || CAST({SPARK.channel} AS STRING) || '] ' || {_PHY_FLAGS} END AS line
        FROM ev""")
    return SRC.phy_frequency_table(lines, ("2.4GHz", "6GHz"))


# =========================================================================================
# Sinks
# =========================================================================================


_TABLE_SQL = {"run": "run", "frequencies": "frequencies", "observations": "observations", "ie_capabilities": "capabilities",
              "rnr": "rnr", "bss_load": "bss_load", "field_resolution": "resolution"}
# Whole relations are compared by a digest of each column: sums of hashes of its cells together with their run. Numbers are
# taken in thousandths, so that no engine's way of printing them matters.
_MADE_OF_NUMBERS = "(DOUBLE|FLOAT|.*INT.*|DECIMAL.*)"
_WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def digest_sql(relation: str, sql: str, key: str = "run_id") -> str:
    cell = f"""coalesce(CASE WHEN typeof(COLUMNS('(.*)')) SIMILAR TO '{_MADE_OF_NUMBERS}'
        THEN CAST(CAST(round(TRY_CAST(CAST(COLUMNS('(.*)') AS VARCHAR) AS DOUBLE) * 1000) AS BIGINT) AS VARCHAR)
        ELSE CAST(COLUMNS('(.*)') AS VARCHAR) END, '-')"""
    salted = f"coalesce(CAST({key} AS VARCHAR), '-') || ':' || {cell}" if key else cell
    # A sum without rows would be no row.
    return f"""SELECT '{relation}' AS relation, column_name, CAST(digest AS BIGINT) AS digest FROM (UNPIVOT (
        SELECT coalesce(sum(CAST('0x' || substr(md5({salted}), 1, 8) AS BIGINT)), 0)::HUGEINT AS '\\1' FROM ({sql}) cells
    ) ON COLUMNS(*) INTO NAME column_name VALUE digest)"""


def digest(relation: str, rows: DataFrame, key: str = "run_id") -> DataFrame:
    def cell(name: str, kind: str):
        value = F.col(f"`{name}`")
        if kind in _WHOLE_NUMBERS or kind.startswith("decimal"):
            value = F.round(value.cast("double") * 1000).cast("bigint")
        text = F.coalesce(value.cast("string"), F.lit("-"))
        text = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("-")), F.lit(":"), text) if key else text
        return F.coalesce(F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")), F.lit(0)).alias(name)

    sums = rows.agg(*[cell(n, k) for n, k in rows.dtypes])
    pairs = F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("digest")) for n in sums.columns]))
    return sums.select(F.lit(relation).alias("relation"), pairs)


def digests(relations: dict[str, DataFrame], key: str = "run_id") -> DataFrame:
    return reduce(DataFrame.unionByName, [digest(name, rows, key) for name, rows in relations.items()])


def digests_sql(relations: dict[str, str], key: str = "run_id") -> str:
    return " UNION ALL ".join(digest_sql(name, sql, key) for name, sql in relations.items())


def _declared(name: str) -> str:
    return f"SELECT {cols(schemas.DERIVED[name])} FROM {_TABLE_SQL[name]}"


@query("b1_write_derived", digests_sql({
    name: _declared(name).replace(" FROM", ", substr(run_id, 1, 8) AS run_date FROM", 1) for name in _TABLE_SQL}))
def b1(i):
    """All seven tables written twice under one batch id, as after a lost attempt, and read back whole."""
    root = i.scratch("derived")
    for name in C.DERIVED_TABLES:
        D.write_derived(i.derived[name].limit(10), root, name, "b1")
        D.write_derived(i.derived[name], root, name, "b1")
    return digests({name: D.read_stored(i.spark, root, name).drop("batch") for name in C.DERIVED_TABLES})


@query("b2_write_manifests", """SELECT r.run_id, r.extraction_status AS status, t.name,
    CAST(coalesce(o.n, 0) AS BIGINT) AS rows, s.n AS n_sources
    FROM run r CROSS JOIN (VALUES ('run.parquet'), ('frequencies.parquet'), ('observations.parquet'), ('ie_capabilities.parquet'),
      ('rnr.parquet'), ('bss_load.parquet'), ('field_resolution.parquet')) t(name)
    LEFT JOIN (""" + " UNION ALL ".join(
        f"SELECT '{name}.parquet' AS name, run_id, count(*) AS n FROM {source} GROUP BY run_id" for name, source in _TABLE_SQL.items()) + """) o
      ON o.run_id = r.run_id AND o.name = t.name
    LEFT JOIN (SELECT run_id, count(DISTINCT pcap_file) AS n FROM captures GROUP BY 1) s ON s.run_id = r.run_id""")
def b2(i):
    root = i.scratch("manifest")
    for table in C.DERIVED_TABLES:
        D.write_derived(i.derived[table], root, table, "b1")
    sources = i.captures.select(
        "run_id", F.col("pcap_file").alias("name"), F.col("length").alias("size"),
        F.sha2(F.col("length").cast("string"), 256).alias("sha256"),
    )
    run = D.read_stored(i.spark, root, "run")
    D.write_manifests(D.build_manifests(run, sources, D.batch_digests(i.spark, root, "b1"), "b1"), root, "b1")
    return D.read_manifest_table(i.spark, root).select(
        "run_id", "status", F.size("source_files").alias("n_sources"), F.inline("outputs")
    ).drop("sha256")


@query("b3_sweep_parquet", digests_sql({n: f"SELECT run_id AS sweep_id, * EXCLUDE (run_id) FROM {n}" for n in ("frequencies", "observations")}, "sweep_id"))
def b3(i):
    root = i.scratch("sweep")
    OUT.write_sweep_parquet(i.observations, i.frequencies, root)
    return digests({n: i.spark.read.parquet(f"{root}/{n}.parquet") for n in ("frequencies", "observations")}, "sweep_id")


@query("b4_census_tsv", f"""SELECT c.run_id, c.bssid, o.ssid, c.elements AS element_ids FROM capabilities c
    JOIN observed o ON o.run_id = c.run_id AND o.bssid = c.bssid""")
def b4(i):
    root = i.scratch("census")
    table = K.ie_census_table(i.derived_table("ie_capabilities"), K.observed_names(i.frames))
    OUT.write_census_tables({"ie-census": table, "rnr": K.rnr_census(i.rnr), "bss-load": K.load_census(i.frames)}, root)
    return i.spark.read.schema("run_id string, bssid string, ssid string, element_ids string").options(
        sep="\t", header=True, quote="", escape="", nullValue="\x00", emptyValue="").csv(f"{root}/ie-census.tsv")


_VIEW_SQL = {
    "pilot_runs": "stg_run", "pilot_frequencies": "stg_frequencies", "pilot_observations": "stg_observations",
    "pilot_ie_capabilities": "stg_ie_capabilities", "pilot_rnr": "stg_rnr", "pilot_bss_load": "stg_bss_load",
    "pilot_field_resolution": "stg_field_resolution", "pilot_run_health": "v_run_health",
    "pilot_hourly_metrics": "v_hourly", "pilot_band_metrics": "v_band",
    "pilot_capability_metrics": "v_capability", "pilot_6ghz_evidence": "v_6ghz",
}


def _view_sql(view: str) -> str:
    table = dict(zip(C.VIEW_NAMES, C.DERIVED_TABLES)).get(view)
    return f"SELECT {cols(schemas.DERIVED[table]) if table else '*'} FROM {_VIEW_SQL[view]}"


@query("b5_publish_views", digests_sql({v: _view_sql(v) for v in _VIEW_SQL}))
def b5(i):
    OUT.publish_views(i.spark, i.views)
    return digests({v: i.spark.table(v) for v in C.VIEW_NAMES})


_SUMMARY = """SELECT h.run_id, CASE WHEN h.mhz < 4900 THEN '2.4GHz' WHEN h.mhz < 5925 THEN '5GHz' ELSE '6GHz' END AS band,
    h.mhz AS frequency_mhz, t.channel, h.bssid, coalesce(h.ssid, '') AS ssid, h.beacons, h.interval_tu AS beacon_interval_tu,
    h.lo AS rssi_min_dbm, h.mean AS rssi_mean_dbm, h.hi AS rssi_max_dbm,
    {0} AS first_seen, {1} AS last_seen,
    round(h.beacons / (t.dwell_seconds / (h.interval_tu * CAST(0.001024 AS DOUBLE))), 3) AS beacon_reception_ratio
    FROM (SELECT run_id, pcap_file, CAST(regexp_extract(pcap_file, '([0-9]+)', 1) AS BIGINT) AS mhz, bssid, count(*) AS beacons, arg_max(ssid_text, frame_number) FILTER (ssid_text <> '') AS ssid,
        arg_max(interval_tu, frame_number) FILTER (interval_tu <> 0) AS interval_tu, min(rssi_dbm) AS lo,
        round_even(avg(rssi_dbm), 1) AS mean, max(rssi_dbm) AS hi,
        arg_min(frame_time_epoch, frame_number) AS first_epoch, arg_max(frame_time_epoch, frame_number) AS last_epoch
      FROM frames GROUP BY 1, 2, 3, 4) h
    LEFT JOIN (SELECT * FROM (SELECT run_id, pcap_file, frequency_mhz, channel, dwell_seconds, row_number() OVER
        (PARTITION BY run_id, pcap_file ORDER BY frequency_mhz, channel, dwell_seconds) AS place FROM frequencies WHERE pcap_file <> '') q
      WHERE place = 1) t ON t.run_id = h.run_id AND t.pcap_file = h.pcap_file""".format(*[
    f"strftime(make_timestamp(CAST(split_part({c}, '.', 1) AS BIGINT) * 1000000 + CAST(substr(split_part({c}, '.', 2), 1, 6) AS BIGINT)), '%Y-%m-%dT%H:%M:%S.%fZ')"
    for c in ("h.first_epoch", "h.last_epoch")])


@query("b6_summary_tsv", f"SELECT * REPLACE (coalesce(bssid, '') AS bssid) FROM ({_SUMMARY}) z")
def b6(i):
    root = i.scratch("summary")
    OUT.write_summary_tables(i.frequencies, E.beacon_summary(i.frames, i.frequencies), root)
    return SRC.read_observations(i.spark, f"{root}/aggregate/run_id=*/*.csv").drop("bad_cell")


# =========================================================================================
# Classification, filters, base views
# =========================================================================================

simple("c1_membership", lambda i: M.classify_membership(i.registry, SERIES).select("name", "membership", "membership_reason"),
       "SELECT name, membership, membership_reason FROM member")
simple("c2_attempt_state", lambda i: i.classified.select("run_id", "attempt_state", "reason", "input_complete"),
       "SELECT run_id, attempt_state, reason, input_complete FROM classified")
simple("c3_eligible", lambda i: i.classified.where("eligible").select("run_id", "attempt_state"),
       "SELECT run_id, attempt_state FROM classified WHERE membership = 'pilot_series'")
for _n, (_view, _source) in enumerate(list(_VIEW_SQL.items())[:7], start=4):
    _table = C.DERIVED_TABLES[_n - 4]
    simple(f"c{_n}_{_view}", lambda i, t=_table: base_view(i.staged_table(t), t), f"SELECT {cols(schemas.DERIVED[_table])} FROM {_source}")
simple("c11_rnr_records", lambda i: i.rnr, f"SELECT {cols(schemas.RNR)} FROM rnr")
simple("c12_structure_status", lambda i: i.derived_table("rnr").groupBy("structure_status", "unpaired_fields").agg(F.count("*").alias("n")),
       "SELECT structure_status, unpaired_fields, count(*) AS n FROM rnr GROUP BY 1, 2")
simple("c13_target_gate",
       lambda i: i.derived_table("rnr").groupBy("structure_status", "op_class", "channel", "target_band", "target_frequency_mhz").agg(F.count("*").alias("n")),
       "SELECT structure_status, op_class, channel, target_band, target_frequency_mhz, count(*) AS n FROM rnr GROUP BY ALL")
simple("c14_bss_load_records", lambda i: i.load, f"SELECT {cols(schemas.BSS_LOAD)} FROM bss_load")
simple("c15_packet_identity",
       lambda i: E.identified_frames(i.frames).groupBy("run_id").agg(F.count("*").alias("frames")),
       "SELECT run_id, count(*) AS frames FROM frames WHERE run_id NOT IN (SELECT run_id FROM frames WHERE bssid IS NULL) GROUP BY run_id")
simple("c16_in_trend", lambda i: M.trend_only(i.frequencies, i.health),
       f"SELECT {cols(schemas.FREQUENCIES)} FROM frequencies WHERE run_id IN (SELECT run_id FROM trend)")
simple("c17_view_disabled",
       lambda i: i.derived_table("rnr").groupBy("disabled_link").agg(
           F.count_if(radio.view_disabled(F.col("disabled_link"))).alias("disabled"),
           F.count_if(radio.view_enabled_or_unknown(F.col("disabled_link"))).alias("enabled_or_unknown")),
       """SELECT disabled_link, count(*) FILTER (disabled_link IN ('True', 'true', '1')) AS disabled,
       count(*) FILTER (disabled_link IS NULL OR disabled_link NOT IN ('True', 'true', '1')) AS enabled_or_unknown FROM rnr GROUP BY 1""")
simple("c18_census_disabled",
       lambda i: i.derived_table("rnr").groupBy("raw_disabled_link").agg(F.count_if(radio.census_disabled(F.col("raw_disabled_link"))).alias("disabled")),
       "SELECT raw_disabled_link, count(*) FILTER (lower(trim(raw_disabled_link)) IN ('1', 'true', 'yes', 'set')) AS disabled FROM rnr GROUP BY 1")
simple("c19_not_regulatory_skip", lambda i: M.not_regulatory_skip(i.frequencies),
       f"SELECT {cols(schemas.FREQUENCIES)} FROM frequencies WHERE sample_status <> 'regulatory_skip'")
simple("c20_defer_running", lambda i: M.defer_running(i.classified).select("run_id", "attempt_state", "deferred"),
       "SELECT run_id, attempt_state, attempt_state = 'running' AS deferred FROM classified WHERE eligible")
simple("c21_permitted", lambda i: M.permitted(i.frequencies),
       f"SELECT {cols(schemas.FREQUENCIES)} FROM frequencies WHERE regulatory_state <> 'disabled'")


@query("c22_sample_status", f"""SELECT v.run_id, v.frequency_mhz, coalesce(s.n, 0) AS bssid_count,
    CAST(coalesce(s.b, 0) AS BIGINT) AS beacon_count, CASE WHEN coalesce(s.b, 0) > 0 THEN 'sampled' ELSE 'sampled_empty' END AS sample_status
    FROM (SELECT DISTINCT run_id, frequency_mhz FROM frequencies) v
    LEFT JOIN (SELECT run_id, frequency_mhz, count(*) AS n, sum(beacons) AS b FROM ({_SUMMARY}) z GROUP BY 1, 2) s
      ON s.run_id = v.run_id AND s.frequency_mhz = v.frequency_mhz""")
def c22(i):
    visited = i.frequencies.select("run_id", "frequency_mhz").distinct()
    return M.derive_sample_status(visited, E.beacon_summary(i.frames, i.frequencies))


# =========================================================================================
# Scalar functions
# =========================================================================================


def scalar(key: str, sql_input: str, outputs: dict, oracle: str, duck_input: str | None = None) -> None:
    """A function over every event: `sql_input` builds the argument columns."""

    def run(i: Inputs) -> DataFrame:
        rows = i.mapped(f"SELECT event_id, {sql_input} FROM ev")
        return rows.select("event_id", *[fn().alias(name) for name, fn in outputs.items()])

    query(key, f"SELECT event_id, {oracle} FROM (SELECT event_id, {duck_input or sql_input} FROM ev) a")(run)


c = F.col
_CELL = ("CASE k % 10 WHEN 0 THEN '  ' WHEN 1 THEN 'x1' WHEN 2 THEN ' ' || CAST(k AS VARCHAR(9)) || ' ' "
         "WHEN 3 THEN CAST(k AS VARCHAR(9)) || '.5' WHEN 4 THEN '-' || CAST(k AS VARCHAR(9)) WHEN 5 THEN NULL ELSE CAST(k AS VARCHAR(9)) END AS x")
scalar("s1_parse_cells", _CELL, {"l": lambda: cells.long_cell(c("x")), "d": lambda: cells.double_cell(c("x"))},
       "CASE WHEN regexp_full_match(trim(x), '[+-]?[0-9]+') THEN TRY_CAST(trim(x) AS BIGINT) END AS l, TRY_CAST(nullif(trim(x), '') AS DOUBLE) AS d")
_RUN = "CASE WHEN k % 9 = 0 THEN '20241301-000000' WHEN k % 9 = 1 THEN 'note' ELSE {0} END AS r"
_REAL = "r <> 'note' AND r <> '20241301-000000'"
scalar("s2_run_hour", _RUN.format(RUN_ID), {"hour": lambda: times.run_hour(c("r")).cast("string")},
       f"CASE WHEN {_REAL} THEN strftime(date_trunc('hour', strptime(r, '%Y%m%d-%H%M%S')), '%Y-%m-%d %H:%M:%S') END AS hour",
       _RUN.format(DUCK.run_id()))
scalar("s3_slot", _RUN.format(RUN_ID), {"slot": lambda: times.slot_of(c("r"))},
       f"CASE WHEN {_REAL} THEN strftime(strptime(r, '%Y%m%d-%H%M%S'), '%Y%m%d-%H') || '0000' END AS slot", _RUN.format(DUCK.run_id()))
_BARE = "lower(regexp_replace(m, '[:-]', '', 'g'))"
_MAC = ("CASE k % 4 WHEN 0 THEN upper({0}) WHEN 1 THEN {0} WHEN 2 THEN replace(upper({1}), ':', '-') ELSE 'zz' || substr({0}, 3) END AS m")
scalar("s4_canonical_mac", _MAC.format(SPARK.mac("u", ""), SPARK.mac("u")), {"mac": lambda: radio.canonical_mac(c("m"))},
       f"CASE WHEN m LIKE 'zz%' THEN m ELSE {colons(_BARE)} END AS mac",
       _MAC.format(DUCK.mac("u", ""), DUCK.mac("u")))
_SET = "CAST(k AS VARCHAR(9)) || ',' || CASE WHEN k % 3 = 0 THEN 'x,, 7' ELSE '201,' || CAST(k AS VARCHAR(9)) || ',-3' END AS x"
scalar("s5_int_set", _SET, {"ids": lambda: F.array_join(cells.int_set(c("x")), ",")},
       "array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(x, ','), lambda t: TRY_CAST(trim(t) AS INT)), lambda t: t IS NOT NULL))), ',') AS ids")
scalar("s6_decode_ssid", f"{SPARK.ssid_hex()} AS ssid_hex", {"ssid": lambda: names.decode_ssid(c("ssid_hex"))},
       f"{DECODED} AS ssid", f"{DUCK.ssid_hex()} AS ssid_hex")
scalar("s7_opclass", "78 + k % 62 AS op, 1 + event_id % 40 AS ch",
       {"band": lambda: radio.opclass_band(c("op")), "mhz": lambda: radio.opclass_mhz(c("op"), c("ch"))},
       "CASE WHEN op IN (81, 82, 83, 84) THEN '2.4GHz' WHEN op >= 112 AND op <= 130 THEN '5GHz' WHEN op >= 131 AND op <= 137 THEN '6GHz' ELSE 'unknown' END AS band, "
       "CASE op WHEN 81 THEN 2407 + 5 * ch WHEN 83 THEN 2407 + 5 * ch WHEN 84 THEN 2407 + 5 * ch WHEN 82 THEN 2484 WHEN 136 THEN 5935 "
       "ELSE CASE WHEN op >= 112 AND op <= 130 THEN 5000 + 5 * ch WHEN op >= 131 AND op <= 137 THEN 5950 + 5 * ch END END AS mhz")
scalar("s8_short_ssid", f"{SPARK.ssid_of('u')} AS s", {"short_ssid": lambda: F.format_string("0x%08x", names.short_ssid(c("s")))},
       "s AS short_ssid", f"{DUCK.short_of('u')} AS s")
scalar("s9_bss_params", "CASE WHEN k % 6 = 0 THEN 'x' ELSE printf('0x%02x', event_id % 256) END AS p",
       {"flags": lambda: F.array_join(radio.bss_parameter_names(c("p")), ", ")},
       "CASE WHEN v IS NOT NULL THEN concat_ws(', ', " + ", ".join(
           f"CASE WHEN v & {1 << n} <> 0 THEN '{name}' END" for n, name in enumerate(C.BSS_PARAMETER_BITS)) + ") END AS flags",
       "CASE WHEN k % 6 = 0 THEN NULL ELSE event_id % 256 END AS v")
_S10 = {n: f"{' OR '.join('(' + (TAGS if n in C.CAPABILITY_TAGS else EXTS)[e] + ')' for e in {**C.CAPABILITY_TAGS, **C.CAPABILITY_EXTENSIONS}[n])}"
        for n in C.CAPABILITY_COLUMNS}
scalar("s10_capability_flags", f"{SPARK.ids(TAGS)} AS t, {SPARK.ids(EXTS)} AS x",
       {n: (lambda n=n: radio.capability_flags(c("t"), c("x"))[n]) for n in C.CAPABILITY_COLUMNS},
       ", ".join(_S10), ", ".join(f"({cond}) AS {n}" for n, cond in _S10.items()))
scalar("s11_generations", f"{SPARK.ids(EXTS)} AS x", {"g": lambda: F.array_join(radio.generations(c("x")), ", ")},
       "concat_ws(', ', CASE WHEN g1 THEN 'HE / Wi-Fi 6' END, CASE WHEN g2 THEN 'HE 6 GHz / Wi-Fi 6E' END, CASE WHEN g3 THEN 'EHT / Wi-Fi 7' END) AS g",
       f"({EXTS[35]}) OR ({EXTS[36]}) AS g1, ({EXTS[59]}) AS g2, ({EXTS[106]}) OR ({EXTS[107]}) OR ({EXTS[108]}) AS g3")
_name_case = lambda table, x: f"CASE {x} " + " ".join(f"WHEN {n} THEN '{v}'" for n, v in table.items()) + f" ELSE '{C.UNMAPPED}' END"
scalar("s12_element_names", "event_id % 256 AS e", {"element": lambda: radio.element_name(c("e")), "extension": lambda: radio.extension_name(c("e"))},
       f"{_name_case(C.ELEMENT_NAMES, 'e')} AS element, {_name_case(C.EXTENSION_NAMES, 'e')} AS extension")
_B, _DB = f"{SPARK.mac('u')} AS b", f"{DUCK.mac('u')} AS b"
_oct = "CAST('0x' || split_part(b, ':', {0}) AS BIGINT)"
scalar("s13_mac_octets", _B, {"octets": lambda: F.array_join(radio.mac_octets(c("b")), ".")},
       " || '.' || ".join(_oct.format(n) for n in range(1, 7)) + " AS octets", _DB)
scalar("s14_locally_administered", _B, {"v": lambda: radio.is_locally_administered(c("b"))}, f"{_oct.format(1)} & 2 <> 0 AS v", _DB)
scalar("s15_multicast", _B, {"v": lambda: radio.is_multicast(c("b"))}, f"{_oct.format(1)} & 1 <> 0 AS v", _DB)
scalar("s16_oui", _B, {"oui": lambda: radio.oui(c("b"))}, f"CASE WHEN {_oct.format(1)} & 2 = 0 THEN substr(b, 1, 8) END AS oui", _DB)
_FAMILY = "substr(b, 4, 12) || substr(b, 16, 1) || '_'"
scalar("s17_radio_family", _B, {"f": lambda: radio.radio_family(c("b"))}, f"{_FAMILY} AS f", _DB)

_NAMES_SQL = """s = '' AS hidden, CAST(length(s) AS BIGINT) AS length,
    s ILIKE 'spectrumsetup-%' OR s ILIKE 'att-wifi-%' OR s ILIKE 'verizon$_%' ESCAPE '$' OR s ILIKE 'breezeline%' OR s ILIKE 'centurylink%'
      OR regexp_full_match(lower(s), 'netgear[0-9]*') OR s ILIKE 'tp-link%' OR s ILIKE 'linksys%' OR s ILIKE 'asus%' OR s ILIKE 'xfinity%' AS isp_default,
    CASE lower(s) WHEN 'spectrum mobile' THEN 'charter_community' WHEN 'xfinitywifi' THEN 'comcast_community' WHEN 'optimumwifi' THEN 'altice_community'
      ELSE CASE WHEN s ILIKE 'spectrumsetup-%' THEN 'charter_spectrum' WHEN s ILIKE 'att-wifi-%' THEN 'att' WHEN s ILIKE 'verizon$_%' ESCAPE '$' THEN 'verizon'
      WHEN s ILIKE 'breezeline%' THEN 'breezeline' WHEN s ILIKE 'centurylink%' THEN 'centurylink' WHEN regexp_full_match(lower(s), 'netgear[0-9]*') THEN 'netgear_oem'
      WHEN s ILIKE 'tp-link%' OR s ILIKE 'linksys%' OR s ILIKE 'asus%' OR s ILIKE 'xfinity%' THEN 'vendor_oem' END END AS provider_family,
    lower(s) IN ('spectrum mobile', 'xfinitywifi', 'optimumwifi') AS shared_service"""
scalar("s18_classify_ssid", f"{SPARK.ssid()} AS s", {n: (lambda n=n: names.classify(c("s"))[n]) for n in
       ("hidden", "length", "isp_default", "provider_family", "shared_service")}, _NAMES_SQL, f"{DUCK.ssid()} AS s")
simple("s19_dwell_span", lambda i: i.observations.select("run_id", "bssid", "first_seen",
       times.dwell_span_seconds(c("first_seen"), c("last_seen")).alias("span")),
       """SELECT run_id, bssid, first_seen, (epoch_us(strptime(last_seen, '%Y-%m-%dT%H:%M:%S.%fZ'))
       - epoch_us(strptime(first_seen, '%Y-%m-%dT%H:%M:%S.%fZ'))) / 1000000.0 AS span FROM observations""")
simple("s20_band_of_frequency", lambda i: i.frequencies.groupBy("frequency_mhz", radio.band_of_frequency(c("frequency_mhz")).alias("band")).agg(F.count("*").alias("n")),
       "SELECT frequency_mhz, band, count(*) AS n FROM frequencies GROUP BY 1, 2")
scalar("s21_regulatory_state", f"{_PHY_FLAGS} AS x", {"state": lambda: radio.regulatory_state(c("x"))}, "x AS state", f"{_PHY_STATE} AS x")
scalar("s22_reception_ratio", "1 + event_id % 120 AS n, CASE WHEN k % 17 = 0 THEN NULL WHEN k % 16 = 0 THEN 0 ELSE 100 + k % 3 END AS tu",
       {"ratio": lambda: radio.reception_ratio(c("n"), F.lit(10), c("tu"))},
       "CASE WHEN tu <> 0 THEN round(n / (10 / (tu * CAST(0.001024 AS DOUBLE))), 3) END AS ratio")
scalar("s23_iso_stamp", f"printf('%d.%06d000', {SPARK.idiv('us', 1000000)}, us % 1000000) AS e", {"stamp": lambda: times.iso_stamp(c("e"))},
       "strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S.%fZ') AS stamp", "us")


@query("s24_single_line", "SELECT doc_id, replace(replace(replace(text, chr(9), ' '), chr(10), ' '), chr(13), ' ') AS text FROM documents")
def s24(i):
    return i.table("documents").select("doc_id", names.single_line(c("text")).alias("text"))


simple("s25_ratio", lambda i: V.frequency_states(i.frequencies, "run_id").select(
    "run_id", "sampled_frequencies", "manifest_frequencies",
    F.round(F.try_divide(c("sampled_frequencies").cast("double"), c("manifest_frequencies")), 6).alias("share")),
    """SELECT run_id, count(*) FILTER (sample_status = 'sampled') AS sampled_frequencies, count(*) AS manifest_frequencies,
    round(count(*) FILTER (sample_status = 'sampled') / count(*), 6) AS share FROM frequencies GROUP BY run_id""")
simple("s26_resolve_fields", lambda i: i.resolution, f"SELECT {cols(schemas.FIELD_RESOLUTION)} FROM resolution")

# =========================================================================================
# Joins
# =========================================================================================

simple("d1_run_health", lambda i: i.views["pilot_run_health"], "SELECT * FROM v_run_health")
simple("d2_hourly_join", lambda i: V.hourly_metrics(i.frequencies, i.observations, i.health).select(
    "run_id", "observed_bssids", "manifest_frequencies"),
    """SELECT t.run_id, coalesce(o.n, 0) AS observed_bssids, f.n AS manifest_frequencies FROM trend t
    JOIN (SELECT run_id, count(*) AS n FROM frequencies GROUP BY 1) f ON f.run_id = t.run_id
    LEFT JOIN (SELECT run_id, count(DISTINCT bssid) AS n FROM observations GROUP BY 1) o ON o.run_id = t.run_id""")
simple("d3_band_join", lambda i: V.band_metrics(i.frequencies, i.observations, i.health).select(
    "run_id", "band", "observed_bssids", "attempted_frequencies"),
    """SELECT f.run_id, f.band, coalesce(o.n, 0) AS observed_bssids, f.n AS attempted_frequencies
    FROM (SELECT run_id, band, count(*) AS n FROM frequencies GROUP BY 1, 2) f JOIN trend t ON t.run_id = f.run_id
    LEFT JOIN (SELECT run_id, band, count(DISTINCT bssid) AS n FROM observations GROUP BY 1, 2) o
      ON o.run_id = f.run_id AND o.band = f.band""")
simple("d4_capability_join", lambda i: V.capability_metrics(i.derived_table("ie_capabilities"), i.health).select("run_id", "started_utc", "observed_bssids"),
       "SELECT t.run_id, t.started_utc, count(*) AS observed_bssids FROM capabilities x JOIN trend t ON t.run_id = x.run_id GROUP BY 1, 2")
simple("d5_trend_semi_join", lambda i: M.trend_only(i.observations, i.health).groupBy("run_id").agg(F.count("*").alias("n")),
       "SELECT run_id, count(*) AS n FROM observations WHERE run_id IN (SELECT run_id FROM trend) GROUP BY run_id")
simple("d6_advertised_not_observed", lambda i: V.advertised_not_observed(i.staged_table("rnr"), i.staged_table("observations")), "SELECT * FROM unheard")
simple("d7_evidence_spine", lambda i: i.views["pilot_6ghz_evidence"], "SELECT * FROM v_6ghz")
simple("d8_missing_slots", lambda i: H.missing_slots(i.slots, i.classified), "SELECT slot FROM missing")

_OUTCOME_SQL = f"""SELECT run_id, neighbor_bssid, CASE WHEN off THEN 'administratively_disabled' WHEN heard THEN 'detected'
      ELSE 'advertised_but_not_observed_in_nonconcurrent_dwell' END AS outcome, band, frequency_mhz, coalesce(ssid, '?') AS ssid, advertised_by
    FROM (SELECT a.run_id, a.nb AS neighbor_bssid, arg_max(a.off, a.o) AS off, arg_max(a.band, a.o) AS band,
        arg_max(coalesce(a.mhz, -1), a.o) AS mhz0, arg_max(coalesce(a.ssid, '?'), a.o) AS ssid, arg_max(a.tx_bssid, a.o) AS advertised_by,
        nullif(arg_max(coalesce(a.mhz, -1), a.o), -1) AS frequency_mhz,
        bool_or(ob.bssid IS NOT NULL) AS heard
      FROM (SELECT v.run_id, {colons('v.neighbor')} AS nb, lower(trim(v.disabled_link)) IN ('1', 'true', 'yes', 'set') AS off,
          CASE WHEN regexp_full_match(v.op_class, '[0-9]+') THEN CASE WHEN v.op_class IN ('81', '82') THEN '2.4GHz' WHEN v.op_class = '115' THEN '5GHz'
            WHEN v.op_class IN ('131', '136') THEN '6GHz' ELSE 'unknown' END ELSE 'unknown' END AS band,
          CASE v.op_class WHEN '81' THEN 2407 + 5 * CAST(v.channel AS BIGINT) WHEN '82' THEN 2484 WHEN '115' THEN 5000 + 5 * CAST(v.channel AS BIGINT)
            WHEN '131' THEN 5950 + 5 * CAST(v.channel AS BIGINT) WHEN '136' THEN 5935 END AS mhz,
          p.ssid, v.tx_bssid, (-v.beacons, v.first_file, v.first_frame) AS o
        FROM adverts v LEFT JOIN pool p ON p.run_id = v.run_id AND p.code = v.short_ssid) a
      LEFT JOIN observed ob ON ob.run_id = a.run_id AND ob.bssid = a.nb GROUP BY 1, 2) z"""
_POOL = ("pool AS (SELECT o.run_id, o.ssid, n.code FROM observed o JOIN (VALUES "
         + ", ".join(f"('{s}', {i})" for i, s in enumerate(SSIDS)) + ") k(ssid, i) ON k.ssid = o.ssid JOIN (SELECT i, "
         + DUCK.short_of("i") + " AS code FROM range(" + str(len(SSIDS)) + ") r(i)) n ON n.i = k.i GROUP BY ALL)")


def with_pool(sql: str) -> str:
    return with_ctes(sql + " /* observed adverts */").replace(f"\n{sql}", f", {_POOL}\n{sql}")


@query("d9_neighbor_outcomes")
def d9(i):
    return K.neighbor_outcomes(K.advertisements(i.derived_table("rnr")), K.observed_names(i.frames))


ORACLES["d9_neighbor_outcomes"] = with_pool(_OUTCOME_SQL)


@query("d9_outcome_totals")
def d9_totals(i):
    return K.outcome_totals(d9(i))


ORACLES["d9_outcome_totals"] = with_pool(f"""SELECT run_id, count(*) FILTER (outcome = 'detected') AS detected,
    count(*) FILTER (outcome LIKE 'advertised%') AS not_observed, count(*) FILTER (outcome LIKE 'admin%') AS disabled,
    CASE WHEN count(*) FILTER (outcome NOT LIKE 'admin%') > 0 THEN 100 * count(*) FILTER (outcome = 'detected') // count(*) FILTER (outcome NOT LIKE 'admin%') END AS detected_pct
    FROM ({_OUTCOME_SQL}) w GROUP BY run_id""")


@query("d10_short_ssid_resolution")
def d10(i):
    rows = K.resolve_short_ssids(K.advertisements(i.derived_table("rnr")), K.observed_names(i.frames))
    return rows.select("run_id", "tx_bssid", "neighbor", "op_class", "channel", "short_ssid", "disabled_link", "bss_params",
                       "mld_link_id", "tx_ssid", "beacons", "neighbor_ssid")


ORACLES["d10_short_ssid_resolution"] = with_pool("""SELECT v.run_id, v.tx_bssid, v.neighbor, v.op_class, v.channel, v.short_ssid, v.disabled_link,
    v.bss_params, v.mld_link_id, v.tx_ssid, v.beacons, p.ssid AS neighbor_ssid
    FROM adverts v LEFT JOIN pool p ON p.run_id = v.run_id AND p.code = v.short_ssid""")


def _current_files(i: Inputs) -> DataFrame:
    """Files as they lie in the tree now: some altered, removed or added since derivation."""
    row = lambda name, size, keep: F.when(keep, F.struct(
        F.lit(name).alias("name"), size.alias("size"), F.sha2(size.cast("string"), 256).alias("sha256")))
    h = F.col("h")
    files = F.array_compact(F.array(
        row("aggregate.tsv", F.col("n") + F.when(h % 79 == 16, 1).otherwise(0), F.lit(True)),
        row("frequencies.tsv", F.col("beacons"), h % 83 != 17),
        row("freq-1.pcap", F.col("n"), h % 89 == 18),
    ))
    return i.runs.select("run_id", F.inline(files))


@query("d11_source_identity", """SELECT run_id, name, change FROM (
    SELECT run_id, 'aggregate.tsv' AS name, CASE WHEN NOT has_manifest THEN 'added' WHEN h % 79 = 16 THEN 'altered' END AS change FROM runs UNION ALL
    SELECT run_id, 'frequencies.tsv', CASE WHEN has_manifest AND h % 83 = 17 THEN 'removed' WHEN NOT has_manifest AND h % 83 <> 17 THEN 'added' END FROM runs UNION ALL
    SELECT run_id, 'freq-1.pcap', CASE WHEN h % 89 = 18 THEN 'added' END FROM runs) f WHERE change IS NOT NULL""")
def d11(i):
    recorded = I.recorded_sources(_manifest_rows(i, i.runs.where("has_manifest")))
    return I.changed_files(recorded, _current_files(i))


def _tampered_outputs(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """True digests of the observations as recorded, and what is found after tampering."""
    h = i.runs.select("run_id", "h")
    actual = I.table_digest(i.observations, "observations")
    recorded = actual.join(h, "run_id").select(
        "run_id", "name",
        (F.col("rows") + F.when(F.col("h") % 97 == 20, 1).otherwise(0)).alias("rows"),
        F.when(F.col("h") % 101 == 21, "0:0").otherwise(F.col("sha256")).alias("sha256"),
    )
    found = actual.join(h, "run_id").where(F.col("h") % 103 != 22).drop("h")
    return recorded, found


_DAMAGE_SQL = """SELECT run_id, 'observations.parquet' AS name, CASE WHEN h % 103 = 22 THEN 'missing output'
    WHEN h % 101 = 21 THEN 'content differs from the manifest' WHEN h % 97 = 20 THEN 'row count differs from the manifest' END AS problem
    FROM runs WHERE h % 103 = 22 OR h % 101 = 21 OR h % 97 = 20"""
simple("d13_output_integrity", lambda i: I.damaged_outputs(*_tampered_outputs(i)), _DAMAGE_SQL)

_REASON = f"""CASE WHEN NOT has_manifest THEN 'no derivation manifest' WHEN status = 'failed' THEN 'prior derivation failed'
    WHEN schema_id <> '{SERIES.derived_schema_id}' THEN 'derived schema changed'
    WHEN extractor_version <> '{SERIES.extractor_version}' THEN 'extractor version changed'
    WHEN h % 79 = 16 OR h % 83 = 17 OR h % 89 = 18 THEN 'source identity changed'
    WHEN h % 103 = 22 OR h % 101 = 21 OR h % 97 = 20 THEN 'derived outputs no longer match the manifest' ELSE 'unchanged' END"""


def _decisions(i: Inputs) -> DataFrame:
    rows = _manifest_rows(i, i.runs.where("has_manifest"))
    changed = I.changed_runs(I.recorded_sources(rows), _current_files(i))
    return I.reprocess_decisions(i.runs, i.manifests, changed, I.damaged_outputs(*_tampered_outputs(i)), SERIES)


simple("d12_reprocess_decision", _decisions, f"SELECT run_id, reason, reason <> 'unchanged' AS needed FROM (SELECT run_id, {_REASON} AS reason FROM runs) r")
simple("d14_unreconciled", lambda i: I.unreconciled_runs(i.classified, i.manifests),
       "SELECT run_id FROM classified WHERE eligible AND attempt_state <> 'running' AND run_id NOT IN (SELECT run_id FROM manifests)")
simple("d15_census_names", lambda i: K.ie_census_table(i.derived_table("ie_capabilities"), K.observed_names(i.frames)),
       "SELECT x.run_id, x.bssid, coalesce(o.ssid, '') AS ssid, x.elements AS element_ids FROM capabilities x LEFT JOIN observed o ON o.run_id = x.run_id AND o.bssid = x.bssid")

# =========================================================================================
# Aggregations
# =========================================================================================

simple("e1_beacon_summary", lambda i: E.beacon_summary(i.frames, i.frequencies), _SUMMARY)
simple("e2_per_frequency", lambda i: S.per_frequency(i.observations),
       """SELECT run_id, band, frequency_mhz, min(channel) AS channel, count(*) AS bssids, CAST(sum(beacons) AS BIGINT) AS beacons,
       max(rssi_mean_dbm) AS strongest_mean_dbm, min(rssi_mean_dbm) AS weakest_mean_dbm FROM observations GROUP BY 1, 2, 3""")
_TOTALS = """SELECT run_id, listed, disabled, populated, empty, skipped, errors, beacons, populated + empty + skipped + errors AS attempted FROM (
    SELECT run_id, count(*) AS listed, count(*) FILTER (sample_status = 'regulatory_skip' AND error LIKE '%disabled%') AS disabled,
    count(*) FILTER (sample_status = 'sampled') AS populated, count(*) FILTER (sample_status = 'sampled_empty') AS empty,
    count(*) FILTER (sample_status = 'regulatory_skip' AND error NOT LIKE '%disabled%') AS skipped,
    count(*) FILTER (sample_status = 'capture_error') AS errors, CAST(coalesce(sum(beacon_count), 0) AS BIGINT) AS beacons
    FROM frequencies GROUP BY run_id) t"""
simple("e3_sweep_totals", lambda i: S.sweep_totals(i.frequencies), _TOTALS)
_BY_BAND = """SELECT run_id, band, count(DISTINCT bssid) AS bssids FROM observations GROUP BY 1, 2
    UNION ALL SELECT run_id, 'all', count(DISTINCT bssid) FROM observations GROUP BY 1"""
simple("e4_addresses_by_band", lambda i: S.addresses_by_band(i.observations), _BY_BAND)
_STATES = """count(*) FILTER (sample_status = 'sampled') AS sampled_frequencies, count(*) FILTER (sample_status = 'sampled_empty') AS sampled_empty_frequencies,
    count(*) FILTER (sample_status = 'regulatory_skip') AS regulatory_skips, count(*) FILTER (sample_status = 'capture_error') AS capture_errors,
    count(*) AS manifest_frequencies"""
simple("e5_frequency_states", lambda i: V.frequency_states(i.frequencies, "run_id"),
       f"SELECT run_id, {_STATES} FROM frequencies GROUP BY run_id")
simple("e6_observation_totals", lambda i: V.observation_totals(i.observations),
       """SELECT run_id, count(DISTINCT bssid) AS observed_bssids, CAST(coalesce(sum(beacons), 0) AS BIGINT) AS beacon_frames,
       round(avg(rssi_mean_dbm), 1) AS mean_rssi_dbm, min(rssi_min_dbm) AS min_rssi_dbm, max(rssi_max_dbm) AS max_rssi_dbm
       FROM observations GROUP BY run_id""")
simple("e7_hourly_metrics", lambda i: V.hourly_metrics(i.staged_table("frequencies"), i.staged_table("observations"), i.health), "SELECT * FROM v_hourly")
simple("e8_band_metrics", lambda i: V.band_metrics(i.staged_table("frequencies"), i.staged_table("observations"), i.health), "SELECT * FROM v_band")
simple("e9_capability_metrics", lambda i: V.capability_metrics(i.staged_table("ie_capabilities"), i.health), "SELECT * FROM v_capability")
simple("e10_direct_6ghz", lambda i: V.direct_6ghz(i.staged_table("observations")), """SELECT run_id, count(*) AS direct_bssids, CAST(sum(b) AS BIGINT) AS direct_beacons
       FROM (SELECT run_id, bssid, coalesce(sum(beacons), 0) AS b FROM stg_observations WHERE band = '6GHz' GROUP BY 1, 2) o GROUP BY 1""")
simple("e11_frequency_states_6ghz", lambda i: V.frequency_states_6ghz(i.staged_table("frequencies")), """SELECT DISTINCT run_id,
         (SELECT count(*) FROM stg_frequencies s WHERE s.run_id = f.run_id AND band = '6GHz' AND sample_status = 'sampled') AS sampled_frequencies,
         (SELECT count(*) FROM stg_frequencies s WHERE s.run_id = f.run_id AND band = '6GHz' AND sample_status = 'sampled_empty') AS sampled_empty_frequencies,
         (SELECT count(*) FROM stg_frequencies s WHERE s.run_id = f.run_id AND band = '6GHz') AS manifest_frequencies
       FROM stg_frequencies f WHERE band = '6GHz'""")
simple("e12_neighbor_state", lambda i: V.neighbor_state(i.staged_table("rnr")), """SELECT DISTINCT run_id, (SELECT count(*) FROM claims c WHERE c.run_id = r.run_id) AS advertised_6ghz_neighbors,
         (SELECT count(*) FROM disabled_claims c WHERE c.run_id = r.run_id) AS advertised_6ghz_disabled_links,
         (SELECT count(*) FROM unknown_claims c WHERE c.run_id = r.run_id) AS unresolved_operating_classes,
         (SELECT count(*) FROM stg_rnr a WHERE a.run_id = r.run_id AND structure_status = 'unpaired_multi_occurrence') AS ambiguous_rnr_rows
       FROM stg_rnr r""")
simple("e13_not_observed_counts", lambda i: V.not_observed_counts(i.staged_table("rnr"), i.staged_table("observations")), "SELECT run_id, count(*) AS advertised_not_observed_nonconcurrent FROM unheard GROUP BY 1")
_EVIDENCE = lambda i: V.evidence_6ghz(
    i.staged_table("frequencies"), i.staged_table("observations"), i.staged_table("rnr"), i.health)
simple("e14_6ghz_evidence", _EVIDENCE, "SELECT * FROM v_6ghz")
simple("e14_readable_evidence", lambda i: V.readable_evidence_6ghz(_EVIDENCE(i), i.staged_table("frequencies"), i.run),
       """SELECT v.*, r.extraction_status, coalesce(f.n, 0) AS visited_frequencies FROM v_6ghz v LEFT JOIN run r ON r.run_id = v.run_id
       LEFT JOIN (SELECT run_id, count(*) AS n FROM stg_frequencies WHERE band = '6GHz' AND sample_status <> 'regulatory_skip' GROUP BY 1) f ON f.run_id = v.run_id""")
simple("e15_ie_capabilities", lambda i: i.capabilities, "SELECT * FROM capabilities")


@query("e16_extraction_status", """SELECT r.run_id, CASE WHEN core IS NOT NULL THEN 'failed' WHEN adv IS NOT NULL THEN 'partial' ELSE 'succeeded' END AS extraction_status,
    nullif(concat_ws('; ', 'core tables: ' || core, 'advanced tables: ' || adv), '') AS error FROM (
      SELECT name AS run_id, CASE WHEN is_dir AND NOT frequencies_ok THEN 'missing source file: frequencies.tsv'
        WHEN is_dir AND NOT aggregate_ok THEN 'missing source file: aggregate.tsv' END AS core,
      (SELECT min(f.pcap_file) || ': beacon row missing packet identity' FROM frames f WHERE f.run_id = runs.name AND f.bssid IS NULL) AS adv
      FROM runs) r""")
def e16(i):
    runs = i.registry.select(F.col("name").alias("run_id"))
    core = E.core_errors(i.registry, i.frequencies.withColumn("bad_cell", F.lit(False)), i.observations.withColumn("bad_cell", F.lit(False)))
    return E.extraction_status(runs, core, E.identity_errors(i.frames))


@query("e17_health_totals", """SELECT
    count(*) FILTER (state = 'completed_sweep' AND eligible) AS completed_sweep, count(*) FILTER (state = 'skipped_no_interface') AS skipped_no_interface,
    count(*) FILTER (state = 'failed') AS failed, count(*) FILTER (state = 'running') AS running, count(*) FILTER (state = 'malformed') AS malformed,
    count(*) FILTER (state = 'missing_hourly_slot') AS missing_hourly_slot, count(*) FILTER (NOT eligible) AS commissioning_reference,
    count(*) FILTER (state <> 'missing_hourly_slot') AS discovered_attempts,
    count(*) FILTER (state <> 'missing_hourly_slot' AND eligible) AS discovered_series_attempts,
    count(*) FILTER (state = 'missing_hourly_slot') + count(DISTINCT CASE WHEN eligible AND state <> 'missing_hourly_slot' THEN substr(run_id, 1, 11) END) AS expected_slots
    FROM health""")
def e17(i):
    return H.health_totals(i.health)


_ATTEMPTED = "count(*) FILTER (sample_status <> 'regulatory_skip') AS attempted, count(*) FILTER (sample_status = 'sampled') AS populated"
simple("e18_coverage", lambda i: P.coverage(i.frequencies), f"""SELECT run_id, count(*) AS listed, {_ATTEMPTED},
       count(*) FILTER (sample_status = 'sampled_empty') AS empty, count(*) FILTER (sample_status = 'regulatory_skip') AS skipped FROM frequencies GROUP BY 1""")
simple("e19_coverage_by_band", lambda i: P.coverage_by_band(i.frequencies), f"""SELECT run_id, band, count(*) AS freqs, {_ATTEMPTED},
       CAST(coalesce(sum(bssid_count), 0) AS BIGINT) AS bssids, CAST(coalesce(sum(beacon_count), 0) AS BIGINT) AS beacons FROM frequencies GROUP BY 1, 2""")
simple("e20_state_by_outcome", lambda i: P.state_by_outcome(i.frequencies), "SELECT run_id, regulatory_state, "
       + ", ".join(f"count(*) FILTER (sample_status = '{s}') AS {s}" for s in C.SAMPLE_STATUSES)
       + ", count(*) FILTER (sample_status IS NULL OR sample_status NOT IN ('sampled', 'sampled_empty', 'regulatory_skip', 'capture_error')) AS other"
       + " FROM frequencies GROUP BY 1, 2")
simple("e21_positive_control", lambda i: P.positive_control(i.frequencies),
       """SELECT run_id, band, detections, attempted, CASE WHEN detections = 0 THEN 'unvalidated' ELSE 'receiver_confirmed' END AS verdict,
       CASE WHEN detections = 0 THEN states END AS regulatory_states FROM (SELECT run_id, band, count(*) FILTER (sample_status = 'sampled') AS detections,
         count(*) AS attempted, array_to_string(list_sort(list(DISTINCT regulatory_state)), ', ') AS states
         FROM frequencies WHERE sample_status <> 'regulatory_skip' GROUP BY 1, 2) p""")
_MODE = "(SELECT run_id, {0} FROM (SELECT run_id, {0}, row_number() OVER (PARTITION BY run_id ORDER BY count(*) DESC, {0}) AS place FROM {1} GROUP BY 1, 2) m WHERE place = 1)"
simple("e22_reception_bounds", lambda i: P.reception_bounds(i.observations, i.frequencies),
       f"""SELECT t.run_id, coalesce(d.dwell_seconds, 10) AS dwell_seconds, n.beacon_interval_tu,
       coalesce(d.dwell_seconds, 10) / (n.beacon_interval_tu * CAST(0.001024 AS DOUBLE)) AS expected_count, t.best_count, t.max_ratio,
       (1 - t.max_ratio) * 100 AS shortfall_pct,
       (SELECT count(*) FROM observations o WHERE o.run_id = t.run_id AND o.beacon_reception_ratio >= t.max_ratio - 1e-9) AS at_bound, t.observations
       FROM (SELECT run_id, max(beacons) AS best_count, max(beacon_reception_ratio) AS max_ratio, count(*) AS observations FROM observations GROUP BY 1) t
       JOIN {_MODE.format('beacon_interval_tu', '(SELECT * FROM observations WHERE beacon_interval_tu IS NOT NULL) oo')} n ON n.run_id = t.run_id
       LEFT JOIN {_MODE.format('dwell_seconds', '(SELECT * FROM frequencies WHERE dwell_seconds > 0) ff')} d ON d.run_id = t.run_id""")
_LOCAL = "CAST('0x' || substr(bssid, 1, 2) AS BIGINT) & 2 <> 0"
_FAM = "substr(bssid, 4, 12) || substr(bssid, 16, 1) || '_'"
_features = lambda i: P.observation_features(i.observations)
simple("e23_identity_summary", lambda i: P.identity_summary(_features(i)),
       f"""SELECT run_id, bssids, radio_families, bssids / radio_families AS bssids_per_radio, l AS locally_administered,
       bssids - l AS globally_administered, l * 100 / bssids AS locally_administered_pct, multicast FROM (
         SELECT run_id, count(DISTINCT bssid) AS bssids, count(DISTINCT {_FAM}) AS radio_families, count(DISTINCT CASE WHEN {_LOCAL} THEN bssid END) AS l,
         count(DISTINCT CASE WHEN CAST('0x' || substr(bssid, 1, 2) AS BIGINT) & 1 <> 0 THEN bssid END) AS multicast FROM observations GROUP BY 1) q""")
simple("e24_radio_families", lambda i: P.radio_families(_features(i)),
       f"""SELECT run_id, {_FAM} AS radio_family, count(DISTINCT bssid) AS bssids, array_to_string(list_sort(list(DISTINCT band)), '/') AS bands,
       avg(rssi_mean_dbm) AS mean_rssi_dbm FROM observations GROUP BY 1, 2""")
simple("e24_radio_family_names", lambda i: P.radio_family_names(_features(i)),
       f"SELECT DISTINCT run_id, {_FAM} AS radio_family, CASE WHEN ssid = '' THEN '<hidden>' ELSE ssid END AS ssid FROM observations")
_FEATURED = "(SELECT *, ssid AS s FROM observations)"
_FIRST = f"""SELECT run_id, bssid, arg_min(hidden, o) AS hidden, arg_min(isp_default, o) AS isp_default, arg_min(shared_service, o) AS shared_service,
    arg_min(provider_family, o) FILTER (provider_family IS NOT NULL) AS provider_family
    FROM (SELECT run_id, bssid, (CASE band WHEN '2.4GHz' THEN 0 WHEN '5GHz' THEN 1 ELSE 2 END, frequency_mhz, bssid, first_seen, beacons, s) AS o, {_NAMES_SQL}
      FROM {_FEATURED} f) g GROUP BY 1, 2"""
simple("e25_ssid_profile", lambda i: P.ssid_profile(_features(i)),
       f"""SELECT a.run_id, count(*) AS bssids, count(*) FILTER (hidden) AS hidden_bssids, count(*) FILTER (isp_default) AS default_names,
       count(*) FILTER (shared_service) AS shared_service_bssids,
       (SELECT count(DISTINCT o.ssid) FROM observations o WHERE o.run_id = a.run_id AND o.ssid <> '') AS unique_ssids FROM ({_FIRST}) a GROUP BY 1""")
simple("e26_shared_services", lambda i: P.shared_services(_features(i)),
       f"""SELECT run_id, ssid, count(DISTINCT bssid) AS bssids, count(DISTINCT {_FAM}) AS radio_families FROM observations
       WHERE lower(ssid) IN ('spectrum mobile', 'xfinitywifi', 'optimumwifi') GROUP BY 1, 2""")
simple("e27_provider_counts", lambda i: P.provider_counts(_features(i)),
       f"SELECT run_id, provider_family, count(*) AS bssids FROM ({_FIRST}) a WHERE provider_family IS NOT NULL GROUP BY 1, 2")
simple("e28_rf_profile", lambda i: P.rf_profile(i.observations),
       """SELECT run_id, band, count(*) AS obs, count(DISTINCT bssid) AS bssids, min(rssi_min_dbm) AS rssi_min, avg(rssi_mean_dbm) AS rssi_mean,
       max(rssi_max_dbm) AS rssi_max, avg(beacon_reception_ratio) AS ratio_mean FROM observations GROUP BY 1, 2""")
simple("e29_channel_occupancy", lambda i: P.channel_occupancy(i.observations),
       """SELECT run_id, band, frequency_mhz, channel, count(DISTINCT bssid) AS bssids, CAST(sum(beacons) AS BIGINT) AS beacons
       FROM observations GROUP BY 1, 2, 3, 4""")
simple("e30_multi_frequency", lambda i: P.multi_frequency_addresses(i.observations),
       """SELECT run_id, bssid, CASE WHEN s = '' THEN '<hidden>' ELSE s END AS label, n_frequencies, frequencies FROM (
       SELECT run_id, bssid, arg_min(ssid, (CASE band WHEN '2.4GHz' THEN 0 WHEN '5GHz' THEN 1 ELSE 2 END, frequency_mhz, bssid, first_seen, beacons, ssid)) AS s,
       count(DISTINCT frequency_mhz) AS n_frequencies, array_to_string(list_sort(list(DISTINCT frequency_mhz)), ', ') AS frequencies
       FROM observations GROUP BY 1, 2) m WHERE n_frequencies > 1""")
simple("e31_observed_names", lambda i: K.observed_names(i.frames), "SELECT * FROM observed")
simple("e32_quality_flags", lambda i: P.quality_flags(i.observations, i.frequencies),
       """SELECT run_id, flag, n, CASE WHEN flag = 'thin_beacon_count' THEN fewest END AS value FROM (
         SELECT f.run_id, unnest(['thin_beacon_count', 'wide_rssi_spread', 'ratio_above_one', 'capture_errors']) AS flag,
           unnest([o.thin, o.wide, o.above, f.errors]) AS n, o.fewest
         FROM (SELECT run_id, count(*) FILTER (error <> '' AND sample_status <> 'regulatory_skip') AS errors FROM frequencies GROUP BY 1) f
         LEFT JOIN (SELECT run_id, count(*) FILTER (beacons < 10) AS thin, count(*) FILTER (rssi_max_dbm - rssi_min_dbm > 15) AS wide,
           count(*) FILTER (beacon_reception_ratio > 1) AS above, min(beacons) AS fewest FROM observations GROUP BY 1) o ON o.run_id = f.run_id) q
       WHERE n > 0 OR flag = 'capture_errors'""")
simple("e33_element_census", lambda i: K.element_census(i.frames),
       f"""SELECT run_id, namespace, element, count(*) AS frames, count(DISTINCT bssid) AS bssids,
       CASE WHEN namespace = 'element' THEN {_name_case(C.ELEMENT_NAMES, 'element')} ELSE {_name_case(C.EXTENSION_NAMES, 'element')} END AS name
       FROM elements GROUP BY 1, 2, 3""")
simple("e33_absent_priority", lambda i: K.absent_priority_elements(i.frames),
       f"""SELECT r.run_id, p.element, {_name_case(C.ELEMENT_NAMES, 'p.element')} AS name FROM (SELECT DISTINCT run_id FROM frames) r
       CROSS JOIN (VALUES {', '.join(f'({e})' for e in C.PRIORITY_ELEMENTS)}) p(element)
       WHERE NOT EXISTS (SELECT 1 FROM elements e WHERE e.run_id = r.run_id AND e.namespace = 'element' AND e.element = p.element)""")
simple("e33_generations", lambda i: K.generations_advertised(i.frames),
       """SELECT run_id, coalesce(nullif(concat_ws(', ', CASE WHEN bool_or(list_has_any(exts, [35, 36])) THEN 'HE / Wi-Fi 6' END,
       CASE WHEN bool_or(list_has_any(exts, [59])) THEN 'HE 6 GHz / Wi-Fi 6E' END,
       CASE WHEN bool_or(list_has_any(exts, [106, 107, 108])) THEN 'EHT / Wi-Fi 7' END), ''), 'none above VHT') AS generations FROM frames GROUP BY 1""")


def _probe_sql() -> str:
    parts = []
    for name in C.RADIOTAP_PROBE:
        verdict = ("CASE WHEN present = 0 THEN 'ABSENT' WHEN vals / present > 1.5 THEN 'POPULATED_REPEATED' "
                   + ("ELSE 'POPULATED_FLAG' END" if name.endswith("badfcs") else "ELSE 'POPULATED' END"))
        parts.append(f"""SELECT run_id, pcap_file, '{name}' AS field, frames, present, 100 * present / frames AS present_pct,
            CASE WHEN present = 0 THEN 0.0 ELSE vals / present END AS values_per_frame, CAST(lit AS BIGINT) AS set_true, {verdict} AS verdict FROM (
            SELECT run_id, pcap_file, count(*) AS frames, count(*) FILTER (len({name}) > 0) AS present, coalesce(sum(len({name})), 0) AS vals,
            coalesce(sum(len(list_filter({name}, lambda v: v IN ('1', 'True')))), 0) AS lit FROM chosen GROUP BY 1, 2) q""")
    return " UNION ALL ".join(parts)


simple("e34_radiotap_population", lambda i: K.radiotap_population(i.frames, i.captures),
       f"""SELECT * FROM (WITH chosen AS (SELECT f.* FROM frames f JOIN (SELECT run_id, arg_min(pcap_file, (-length, pcap_file)) AS pcap_file FROM captures
         WHERE length > 24 GROUP BY 1) l ON l.run_id = f.run_id AND l.pcap_file = f.pcap_file) {_probe_sql()}) z""")
simple("e35_truncation", lambda i: K.truncation(i.frames),
       """SELECT run_id, count(*) AS frames, max(captured_length) AS largest_captured,
       count(*) FILTER (captured_length < wire_length) AS truncated FROM frames GROUP BY 1""")
simple("e36_advertisements", lambda i: K.advertisements(i.derived_table("rnr")).drop("first"), "SELECT * EXCLUDE (first_file, first_frame) FROM adverts")
simple("e36_ambiguous", lambda i: K.ambiguous_reports(i.derived_table("rnr")),
       "SELECT run_id, count(*) AS rows, count(*) FILTER (structure_status <> 'single_occurrence') AS skipped_ambiguous FROM rnr GROUP BY 1")
_DIG = lambda x: f"CASE WHEN regexp_full_match({x}, '[0-9]+') THEN CAST({x} AS BIGINT) END"
simple("e37_load_ranges", lambda i: K.load_ranges(i.derived_table("bss_load")),
       f"""SELECT *, utilization_min * 100 // 255 AS utilization_min_pct, utilization_max * 100 // 255 AS utilization_max_pct FROM (
       SELECT run_id, bssid, arg_min(ssid, (pcap_file, frame_number)) AS ssid, count(*) AS frames,
       min({_DIG('raw_utilization')}) AS utilization_min, max({_DIG('raw_utilization')}) AS utilization_max,
       min({_DIG('raw_station_count')}) AS stations_min, max({_DIG('raw_station_count')}) AS stations_max FROM bss_load GROUP BY 1, 2) q""")
_CHECKS = {
    "element_71_multiple_bssid": "list_contains(tags, 71)", "element_201_rnr": "list_contains(tags, 201)",
    "element_11_bss_load": "list_contains(tags, 11)", "element_195_tx_power_envelope": "list_contains(tags, 195)",
    "element_244_rsnx": "list_contains(tags, 244)", "element_107_interworking": "list_contains(tags, 107)",
    "any_extension_element": "len(exts) > 0", "he_bss_color": "len(he_bss_color) > 0",
    "rnr_mld_link_id": "len(rnr_mld_link_id) > 0", "fcs_failures": "list_contains(radiotap_flags_badfcs, 'True')",
}
simple("e38_identity_counts", lambda i: K.identity_counts(i.frames), " UNION ALL ".join(
    f"SELECT run_id, '{n}' AS \"check\", count(*) FILTER ({cond}) AS frames FROM frames GROUP BY run_id" for n, cond in _CHECKS.items()))

# --- Briefing -------------------------------------------------------------------------------

_SEVEN = ("populated_frequencies", "sampled_empty_frequencies", "regulatory_skips", "capture_errors", "attempted_frequencies",
          "observed_bssids", "beacon_frames")
_big = lambda *ns: ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in ns)
_hourly = lambda i: V.hourly_metrics(i.staged_table("frequencies"), i.staged_table("observations"), i.health)
_bands = lambda i: V.band_metrics(i.staged_table("frequencies"), i.staged_table("observations"), i.health)
_capab = lambda i: V.capability_metrics(i.staged_table("ie_capabilities"), i.health)
simple("e39_coverage_totals", lambda i: B.coverage_totals(_bands(i)), f"SELECT band, {_big(*_SEVEN)} FROM v_band GROUP BY band")
_SNAP = """SELECT '{0}' AS measure, count(*) AS trend_runs, arg_max({0}, run_id) AS latest, min({0}) AS lowest, median({0}) AS median, max({0}) AS highest FROM v_hourly"""
simple("e40_snapshot", lambda i: B.snapshot(_hourly(i)), " UNION ALL ".join(_SNAP.format(m) for m in ("observed_bssids", "beacon_frames")))
_CAPS = ("advertises_he", "advertises_he_6ghz", "advertises_eht", "advertises_mld", "advertises_multiple_bssid", "carries_rnr", "carries_bss_load")
simple("e41_capability_totals", lambda i: B.capability_totals(_capab(i)), f"SELECT {_big(*_CAPS, 'observed_bssids')} FROM v_capability")
simple("e41_latest_capabilities", lambda i: B.latest_row(_capab(i)), "SELECT * FROM v_capability ORDER BY run_id DESC LIMIT 1")
simple("e42_unresolved_fields", lambda i: B.unresolved_fields(i.staged_table("field_resolution")),
       "SELECT DISTINCT logical_name FROM stg_field_resolution WHERE status = 'unresolved'")
simple("e42_ambiguity", lambda i: B.ambiguity(i.staged_table("rnr")),
       "SELECT count(*) AS ambiguous_rows, count(DISTINCT run_id) AS runs FROM stg_rnr WHERE structure_status = 'unpaired_multi_occurrence'")
simple("e42_extraction_failures", lambda i: B.extraction_failures(i.run),
       "SELECT run_id, extraction_status, error FROM run WHERE extraction_status <> 'succeeded'")
_LOADS = """SELECT count(*) AS frames, count(DISTINCT bssid) AS bssids, count(DISTINCT run_id) AS runs, min(station_count) AS stations_min,
    max(station_count) AS stations_max, min(utilization) AS utilization_min, max(utilization) AS utilization_max FROM stg_bss_load"""
simple("e43_load_summary", lambda i: B.load_summary(i.staged_table("bss_load")), _LOADS)
_SIXES = ("direct_bssids", "direct_beacons", "sampled_frequencies", "sampled_empty_frequencies", "manifest_frequencies", "advertised_6ghz_neighbors",
          "advertised_6ghz_disabled_links", "unresolved_operating_classes", "ambiguous_rnr_rows", "advertised_not_observed_nonconcurrent")
simple("e44_evidence_totals", lambda i: B.evidence_totals(_EVIDENCE(i)), f"SELECT {_big(*_SIXES)} FROM v_6ghz")
simple("e44_latest_evidence", lambda i: B.latest_row(_EVIDENCE(i)), "SELECT * FROM v_6ghz ORDER BY run_id DESC LIMIT 1")
_commissioning = lambda i: B.commissioning_summary(
    *SRC.read_commissioning(i.frequencies, i.observations, SERIES.commissioning), SERIES.commissioning)
_COMM = f"""SELECT f.run_id, count(*) AS frequencies, count(*) FILTER (sample_status = 'sampled') AS sampled,
    (SELECT count(*) FROM observations o WHERE o.run_id = f.run_id) AS observations,
    (SELECT count(DISTINCT bssid) FROM observations o WHERE o.run_id = f.run_id) AS bssids, TRUE AS present FROM frequencies f
    WHERE f.run_id IN ('{SERIES.commissioning[0]}', '{SERIES.commissioning[1]}') GROUP BY 1
    UNION ALL SELECT run_id, 0, 0, 0, 0, FALSE FROM (VALUES ('{SERIES.commissioning[0]}'), ('{SERIES.commissioning[1]}')) c(run_id)
    WHERE run_id NOT IN (SELECT run_id FROM frequencies)"""
simple("e45_commissioning_summary", _commissioning, _COMM)
_MARKS = """SELECT 'data_cutoff' AS marker, max(started_utc) AS text FROM stg_run UNION ALL SELECT 'latest_input', max(run_id) FROM health
    UNION ALL SELECT 'last_successful_sweep', max(run_id) FROM v_hourly UNION ALL SELECT 'last_discovered_attempt', max(run_id) FROM stg_run"""
simple("e46_markers", lambda i: B.markers(i.staged_table("run"), i.health, _hourly(i)), _MARKS)
simple("e46_derivation_counts", lambda i: B.derivation_counts(i.run), "SELECT extraction_status, count(*) AS runs FROM run GROUP BY 1")
_FINDINGS = """SELECT 'unresolved_field' AS finding, logical_name AS subject, NULL AS detail, 1 AS n FROM stg_field_resolution WHERE status = 'unresolved' GROUP BY 2
    UNION ALL SELECT 'ambiguous_rnr_rows', NULL, CAST(count(DISTINCT run_id) AS VARCHAR), count(*) FROM stg_rnr WHERE structure_status = 'unpaired_multi_occurrence'
    UNION ALL SELECT 'derivation_incomplete', run_id, extraction_status || ': ' || coalesce(error, 'no detail'), 1 FROM stg_run WHERE extraction_status <> 'succeeded'
    UNION ALL SELECT 'attempt_state', state, NULL, count(*) FROM health WHERE state IN ('failed', 'malformed', 'running') GROUP BY 2
    UNION ALL SELECT 'missing_slot', slot, NULL, 1 FROM missing"""
simple("e46_findings", lambda i: B.findings(i.staged_table("run"), i.health, i.staged_table("rnr"), i.staged_table("field_resolution")), _FINDINGS)
simple("e47_sweep_window", lambda i: P.sweep_window(i.observations),
       "SELECT run_id, min(first_seen) AS window_start, max(last_seen) AS window_end FROM observations GROUP BY 1")
simple("e48_capture_counts", lambda i: K.capture_counts(i.captures),
       "SELECT run_id, count(*) FILTER (length > 24) AS populated_captures, count(*) AS captures FROM captures GROUP BY 1")
simple("e49_sweep_verdict", lambda i: S.sweep_verdict(S.sweep_totals(i.frequencies)),
       f"SELECT run_id, CASE WHEN errors > 0 OR populated + empty = 0 THEN 'bad' ELSE 'ok' END AS verdict FROM ({_TOTALS}) v")

# =========================================================================================
# Order and top rows, set operations
# =========================================================================================


@query("w1_first_occurrence", f"""SELECT run_id, frequency_mhz, event_id FROM (SELECT {DUCK.run_id()} AS run_id, CAST({DUCK.mhz} AS BIGINT) AS frequency_mhz,
    event_id, row_number() OVER (PARTITION BY {DUCK.run_id()}, {DUCK.mhz} ORDER BY event_id) AS place FROM ev) p WHERE place = 1""")
def w1(i):
    """The first line that names a frequency wins; here each line's channel is its event."""
    lines = i.mapped(f"""SELECT {RUN_ID} AS run_id, event_id AS line_no,
        '\\t\\t* ' || CAST({SPARK.mhz} AS STRING) || '.0 MHz [' || CAST(event_id AS STRING) || '] (30.0 dBm)' AS line FROM ev""")
    return SRC.phy_frequency_table(lines, ("2.4GHz", "5GHz", "6GHz")).select("run_id", "frequency_mhz", F.col("channel").alias("event_id"))


simple("w2_last_values", lambda i: E.beacon_summary(i.frames, i.frequencies).select("run_id", "frequency_mhz", "bssid", "ssid", "beacon_interval_tu", "first_seen", "last_seen"),
       f"SELECT run_id, frequency_mhz, bssid, ssid, beacon_interval_tu, first_seen, last_seen FROM ({_SUMMARY}) z")
simple("w3_first_per_address", lambda i: P.per_address_names(_features(i)), _FIRST)
simple("w4_recent_runs", lambda i: B.recent_runs(_hourly(i)), "SELECT * FROM v_hourly ORDER BY run_id DESC LIMIT 12")
simple("w4_omitted_runs", lambda i: B.omitted_runs(_hourly(i)),
       "SELECT count(*) AS trend_runs, greatest(count(*) - 12, 0) AS omitted FROM v_hourly")
simple("w5_latest_run", lambda i: B.latest_row(_hourly(i)), "SELECT * FROM v_hourly ORDER BY run_id DESC LIMIT 1")
simple("w6_ordered_health", lambda i: i.health.orderBy("run_id"), "SELECT * FROM health ORDER BY run_id")
simple("w7_band_order", lambda i: S.in_band_order(S.addresses_by_band(i.observations)), _BY_BAND)
simple("w8_descending_counts", lambda i: P.channel_occupancy(i.observations).orderBy(F.desc("bssids"), "run_id", "band", "frequency_mhz", "channel"),
       """SELECT run_id, band, frequency_mhz, channel, count(DISTINCT bssid) AS bssids,
       CAST(sum(beacons) AS BIGINT) AS beacons FROM observations GROUP BY 1, 2, 3, 4 ORDER BY bssids DESC, run_id, band, frequency_mhz, channel""")
simple("u1_health_union", lambda i: i.health, "SELECT * FROM health")
# Runs of the first half come from a batch that did not have two columns yet.
_OLD = "run_id < '20240116-000000'"
simple("u2_layer_union", lambda i: schemas.union_layers(
    [i.observations.where(_OLD).drop("channel", "beacon_reception_ratio"), i.observations.where(f"NOT ({_OLD})")], schemas.OBSERVATIONS),
    f"""SELECT * REPLACE (CASE WHEN NOT ({_OLD}) THEN channel END AS channel,
        CASE WHEN NOT ({_OLD}) THEN beacon_reception_ratio END AS beacon_reception_ratio) FROM observations""")
simple("u3_id_difference", lambda i: i.classified.where("eligible").select("run_id").exceptAll(i.manifests.select("run_id")),
       "SELECT run_id FROM classified WHERE eligible EXCEPT ALL SELECT run_id FROM manifests")
simple("u4_advertised_pairs", lambda i: V.advertised_pairs(i.staged_table("rnr")), "SELECT * FROM enabled_neighbors")
simple("u5_expected_slots", lambda i: i.slots, "SELECT slot FROM slots")
simple("u6_element_union", lambda i: E.element_counts(i.frames),
       """SELECT run_id, bssid, namespace, element, count(*) AS frames FROM elements GROUP BY 1, 2, 3, 4
       UNION ALL SELECT run_id, lower(bssid), NULL, NULL, count(*) FROM frames WHERE len(tags) = 0 AND len(exts) = 0 GROUP BY 1, 2""")

# =========================================================================================
# Jobs
# =========================================================================================

simple("p1_plan_update", lambda i: I.update_outcomes(i.classified, _decisions(i)),
       f"""SELECT x.run_id, x.attempt_state, CASE WHEN x.attempt_state = 'running' THEN 'deferred' WHEN d.reason <> 'unchanged' THEN 'processed' ELSE 'unchanged' END AS outcome,
       CASE WHEN x.attempt_state = 'running' THEN 'run in progress; enrichment deferred' ELSE d.reason END AS detail
       FROM classified x LEFT JOIN (SELECT run_id, {_REASON} AS reason FROM runs) d ON d.run_id = x.run_id WHERE x.eligible""")


# Run rows are of finished eligible attempts, with the status that text tables and frames lead to; the rest is as in the mapped tables.
_DONE = "(SELECT c.*, r.frequencies_ok, r.aggregate_ok FROM classified c JOIN runs r ON r.run_id = c.run_id WHERE c.eligible AND c.attempt_state <> 'running')"
_P2_RUN = ("run_id", "attempt_state", "run_status", "started_utc", "eligible", "input_complete", "extraction_status")


@query("p2_enrich", digests_sql({name: _declared(name) for name in _TABLE_SQL if name not in ("run", "field_resolution")} | {
    "run": f"""SELECT run_id, attempt_state, run_status, started_utc, eligible, input_complete,
        CASE WHEN NOT (frequencies_ok AND aggregate_ok) THEN 'failed' WHEN run_id IN (SELECT run_id FROM frames WHERE bssid IS NULL) THEN 'partial'
        ELSE 'succeeded' END AS extraction_status FROM {_DONE} d""",
    "field_resolution": f"SELECT run_id, logical_name FROM {_DONE} d, (VALUES " + ", ".join(f"('{n}')" for n in C.FIELD_CANDIDATES) + ") v(logical_name)",
}))
def p2(i):
    from quietband.plans.enrich import derive_tables

    flagged = lambda rows: rows.withColumn("bad_cell", F.lit(False))
    tables = derive_tables(i.finished, i.registry, flagged(i.frequencies), flagged(i.observations), i.frames, SERIES, i.identity_errors)
    tables["run"] = tables["run"].select(*_P2_RUN)
    tables["field_resolution"] = tables["field_resolution"].select("run_id", "logical_name")
    return digests({name: tables[name] for name in C.DERIVED_TABLES})


@query("p3_build_views", digests_sql({v: _view_sql(v) for v in _VIEW_SQL}))
def p3(i):
    return digests(i.views)


def _briefing_sql() -> str:
    def rows(source: str, section: str, parts: list[tuple]) -> list[str]:
        out = []
        for metric, num, den, value, run, label in parts:
            value = value or (f"CAST({num} AS DOUBLE) / {den}" if num and den else "NULL")
            out.append(f"""SELECT '{section}' AS section, {metric} AS metric, {run or 'NULL'} AS run_id, CAST({num or 'NULL'} AS BIGINT) AS numerator,
                CAST({den or 'NULL'} AS BIGINT) AS denominator, CAST({value} AS DOUBLE) AS value, CAST({label or 'NULL'} AS VARCHAR) AS label FROM ({source}) src""")
        return out

    sec = C.BRIEFING_SECTIONS
    n = lambda name, den=None, run=None, label=None, prefix="": (f"'{prefix}{name}'", name, den, None, run, label)
    health = ("SELECT count(*) FILTER (state = 'completed_sweep' AND eligible) AS completed_sweep, "
              + ", ".join(f"count(*) FILTER (state = '{s}') AS {s}" for s in C.ATTEMPT_STATES[1:])
              + ", count(*) FILTER (NOT eligible) AS commissioning_reference, count(*) FILTER (state <> 'missing_hourly_slot' AND eligible) AS discovered_series_attempts, "
              "count(*) FILTER (state = 'missing_hourly_slot') + count(DISTINCT CASE WHEN eligible AND state <> 'missing_hourly_slot' THEN substr(run_id, 1, 11) END) AS expected_slots FROM health")
    recent = "SELECT * FROM v_hourly ORDER BY run_id DESC LIMIT 12"
    parts = (
        rows(_MARKS, sec[0], [("marker", None, None, None, None, "text")])
        + rows(health, sec[1], [n(m) for m in (*C.ATTEMPT_STATES, "commissioning_reference", "discovered_series_attempts", "expected_slots")])
        + rows("SELECT extraction_status, count(*) AS runs FROM stg_run GROUP BY 1", sec[1], [("'derivation_status'", "runs", None, None, None, "extraction_status")])
        + rows(f"SELECT band, {_big(*_SEVEN)} FROM v_band GROUP BY band", sec[2],
               [n(m, "attempted_frequencies", None, "band") for m in _SEVEN[:4]] + [n(m, None, None, "band") for m in _SEVEN[5:]])
        + rows(ORACLE_SNAP, sec[3], [(f"measure || '_{s}'", None, "trend_runs", s, None, None) for s in ("latest", "lowest", "median", "highest")])
        + rows("SELECT count(*) AS trend_runs, greatest(count(*) - 12, 0) AS omitted FROM v_hourly", sec[3], [("'omitted_runs'", "omitted", "trend_runs", None, None, None)])
        + rows(recent, sec[3], [n(m, None, "run_id") for m in ("observed_bssids", "beacon_frames", "sampled_frequencies", "sampled_empty_frequencies")]
               + [("'mean_rssi_dbm'", None, None, "mean_rssi_dbm", "run_id", None)])
        + rows(f"SELECT {_big(*_CAPS, 'observed_bssids')} FROM v_capability", sec[4], [n(m, "observed_bssids") for m in _CAPS])
        + rows("SELECT * FROM v_capability ORDER BY run_id DESC LIMIT 1", sec[4], [n(m, "observed_bssids", "run_id", None, "latest_") for m in _CAPS[:5]])
        + rows(f"SELECT {_big(*_SIXES)} FROM v_6ghz", sec[5], [n(m) for m in _SIXES])
        + rows("SELECT * FROM v_6ghz ORDER BY run_id DESC LIMIT 1", sec[5], [n(m, None, "run_id", None, "latest_") for m in _SIXES])
        + rows(_LOADS, sec[6], [n(m) for m in ("frames", "bssids", "runs", "stations_min", "stations_max")] + [n(m, "255") for m in ("utilization_min", "utilization_max")])
        + rows(_FINDINGS, sec[7], [("finding", "n", None, None, None, "concat_ws(' ', subject, detail)")])
        + rows(_COMM, sec[8], [("'present'", "CAST(present AS INT)", None, None, "run_id", None)]
               + [n(m, None, "run_id") for m in ("frequencies", "sampled", "observations", "bssids")])
    )
    return " UNION ALL ".join(parts)


ORACLE_SNAP = " UNION ALL ".join(_SNAP.format(m) for m in ("observed_bssids", "beacon_frames"))
simple("p4_briefing_metrics", lambda i: briefing_from_views(store_run_grain(i.spark, i.views), _commissioning(i)), _briefing_sql())
_MADE_FROM = [("Scope and cutoff", "series_start", SERIES.series_start), *[("Scope and cutoff", "commissioning_run", r) for r in SERIES.commissioning],
              ("Provenance", "derived_schema_id", "survey-derived/1"), ("Provenance", "extractor_version", "quietband-enrich/1"),
              ("Provenance", "source_root", "/survey"), ("Provenance", "derived_root", "/derived"), *[("Provenance", "view", v) for v in _VIEW_SQL]]
simple("b7_briefing", lambda i: whole_briefing(i.spark, store_run_grain(i.spark, i.views), _commissioning(i), SERIES, "/survey", "/derived"),
       _briefing_sql() + " UNION ALL SELECT s, m, NULL, NULL, NULL, NULL, l FROM (VALUES "
       + ", ".join(f"('{s}', '{m}', '{v}')" for s, m, v in _MADE_FROM) + ") v(s, m, l)")


# Relation of the profile -> query that computes it alone.
_PROFILE = {
    "window": "e47_sweep_window", "coverage": "e18_coverage", "coverage_by_band": "e19_coverage_by_band",
    "state_by_outcome": "e20_state_by_outcome", "positive_control": "e21_positive_control", "reception_bounds": "e22_reception_bounds",
    "identity": "e23_identity_summary", "radio_families": "e24_radio_families", "radio_family_names": "e24_radio_family_names",
    "ssid_profile": "e25_ssid_profile", "shared_services": "e26_shared_services", "provider_counts": "e27_provider_counts",
    "rf_profile": "e28_rf_profile", "channel_occupancy": "e29_channel_occupancy", "multi_frequency": "e30_multi_frequency",
    "quality_flags": "e32_quality_flags", "per_frequency": "e2_per_frequency", "sweep_totals": "e3_sweep_totals",
    "addresses_by_band": "e4_addresses_by_band", "verdict": "e49_sweep_verdict",
}


@query("p5_profile_sweeps", digests_sql({name: ORACLES[key] for name, key in _PROFILE.items()} | {
    "features": "SELECT run_id, bssid, frequency_mhz, ssid, beacons FROM observations"}))
def p5(i):
    from quietband.plans.profile import profile_sweeps

    found = profile_sweeps(i.frequencies, i.observations)
    found["features"] = found["features"].select("run_id", "bssid", "frequency_mhz", "ssid", "beacons")
    assert found.keys() == _PROFILE.keys() | {"features"}
    return digests(found)


# Relation of the census -> query that computes it alone.
_CENSUS = {
    "captures": "e48_capture_counts", "radiotap": "e34_radiotap_population", "truncation": "e35_truncation", "elements": "e33_element_census",
    "absent_priority": "e33_absent_priority", "generations": "e33_generations", "ambiguous": "e36_ambiguous",
    "neighbor_outcomes": "d9_neighbor_outcomes", "outcome_totals": "d9_outcome_totals", "load_ranges": "e37_load_ranges",
    "identity": "e38_identity_counts", "observed": "e31_observed_names",
}


@query("p6_census_captures", digests_sql({name: ORACLES[key] for name, key in _CENSUS.items()}))
def p6(i):
    from quietband.plans.census import census_captures

    # Neighbor and load reports count for runs whose every frame has identity, as the derived tables take them.
    whole, derived = census_captures(i.frames, i.captures), census_captures(i.identified, i.captures)
    reports = ("ambiguous", "neighbor_outcomes", "outcome_totals", "load_ranges")
    return digests({name: (derived if name in reports else whole)[name] for name in _CENSUS})


# =========================================================================================
# Extensions: run-to-run comparisons
# =========================================================================================

# The whole series, split at a boundary as an instrument change would split it.
_split = lambda boundary: f"CASE WHEN run_id < '{boundary}' THEN 'before' ELSE 'after' END"
_EARLY, _MIDDLE = _split("20240101-120000"), _split("20240116-000000")


def _sides(i: Inputs, split: str) -> DataFrame:
    return i.observations.withColumn("run_id", F.expr(split))


_SIDES_SQL = f"(SELECT *, {_MIDDLE} AS side FROM observations)"
simple("x1_churn", lambda i: X.churn(_sides(i, _EARLY), "before", "after"),
       f"""SELECT bssid, CASE WHEN bool_or({_EARLY} = 'before') THEN 'lost' ELSE 'gained' END AS change
       FROM observations GROUP BY bssid HAVING count(DISTINCT {_EARLY}) = 1""")
simple("x2_rssi_shift", lambda i: X.rssi_shift(_sides(i, _MIDDLE), "before", "after"),
       f"""SELECT a.bssid, a.frequency_mhz, a.m AS before_dbm, b.m AS after_dbm, b.m - a.m AS delta_db
       FROM (SELECT bssid, frequency_mhz, avg(rssi_mean_dbm) AS m FROM {_SIDES_SQL} s WHERE side = 'before' GROUP BY 1, 2) a
       JOIN (SELECT bssid, frequency_mhz, avg(rssi_mean_dbm) AS m FROM {_SIDES_SQL} s WHERE side = 'after' GROUP BY 1, 2) b
         ON a.bssid = b.bssid AND a.frequency_mhz = b.frequency_mhz WHERE a.m IS NOT NULL AND b.m IS NOT NULL""")
simple("x3_sweep_comparison", lambda i: X.sweep_comparison(i.observations),
       """SELECT run_id, count(DISTINCT (band, frequency_mhz)) AS populated, CAST(sum(beacons) AS BIGINT) AS beacons, min(rssi_mean_dbm) AS weakest_mean_dbm,
       count(DISTINCT CASE WHEN band = '2.4GHz' THEN bssid END) AS bssids_2_4, count(DISTINCT CASE WHEN band = '5GHz' THEN bssid END) AS bssids_5,
       count(DISTINCT CASE WHEN band = '6GHz' THEN bssid END) AS bssids_6, count(DISTINCT bssid) AS bssids FROM observations GROUP BY run_id""")
simple("x4_outcome_by_regime", lambda i: X.outcome_by_regime(i.frequencies),
       """SELECT regulatory_state, sample_status, count(*) AS rows, count(DISTINCT run_id) AS runs FROM frequencies WHERE band = '6GHz' GROUP BY 1, 2""")
simple("x5_count_reconciliation", lambda i: X.count_reconciliation(i.observations, i.staged_table("observations")),
       """SELECT run_id, count(*) AS source_rows, 0 AS derived_rows FROM observations WHERE run_id NOT IN (SELECT run_id FROM core_ok) GROUP BY 1""")
simple("x6_tallies", lambda i: X.tallies(i.derived_table("rnr")),
       """SELECT structure_status, target_band, tx_bssid IS NULL OR frame_number IS NULL AS identity_missing, count(*) AS rows FROM rnr GROUP BY ALL""")

"""Survey-shaped relations derived from the `events` table.

Each event becomes one manifest row, one observation and one beacon frame of an hourly run.
The same arithmetic is written for Spark and for DuckDB; the few places where the dialects
differ are the methods of ``Dialect``.  Nothing is filtered: every event takes part.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from datetime import datetime

from quietband.config import SeriesConfig

# Hours 0 and 1 are commissioning, 2 and 3 precede the series, 4 is its first run.
SERIES = SeriesConfig(
    series_start="20240101-040028", commissioning=("20240101-000000", "20240101-010007")
)
NOW = datetime(2024, 1, 30, 23, 30)

SSIDS = (
    "SpectrumSetup-07", "ATT-WIFI-q1", "Verizon_ABC", "breezeline 9", "CenturyLink12", "NETGEAR24",
    "Linksys-guest", "xfinitywifi", "Spectrum Mobile", "optimumwifi", "Home net", "Café über",
)
TAGS = {
    0: "TRUE", 1: "TRUE", 3: "k % 3 = 0", 5: "k % 2 = 1", 11: "k % 3 = 0", 45: "k % 2 = 0",
    48: "k % 5 <> 1", 71: "k % 11 = 0", 107: "k % 13 = 0", 127: "k % 4 = 1", 191: "k % 5 = 0",
    195: "k % 17 = 0", 201: "k % 4 <> 3", 221: "TRUE", 244: "k % 19 = 0", 250: "k % 23 = 0",
}
EXTS = {
    35: "k % 3 <> 2", 36: "k % 6 = 0", 59: "k % 9 = 0", 106: "k % 7 = 1", 107: "k % 14 = 1",
    108: "k % 7 IN (1, 2)", 200: "k % 37 = 0",
}
RNR = TAGS[201]
LOAD = TAGS[11]


@dataclass(frozen=True)
class Dialect:
    name: str

    @property
    def spark(self) -> bool:
        return self.name == "spark"

    def idiv(self, a: str, b: int) -> str:
        return f"({a} div {b})" if self.spark else f"({a} // {b})"

    def array(self, *items: str) -> str:
        body = ", ".join(items)
        return f"array({body})" if self.spark else f"[{body}]"

    def compact(self, *items: str) -> str:
        body = self.array(*items)
        return f"array_compact({body})" if self.spark else f"list_filter({body}, lambda x: x IS NOT NULL)"

    def join(self, array: str, sep: str = ",") -> str:
        return f"array_join({array}, '{sep}')" if self.spark else f"array_to_string({array}, '{sep}')"

    def text(self, x: str) -> str:
        return f"CAST({x} AS {'STRING' if self.spark else 'VARCHAR'})"

    def sha(self, x: str) -> str:
        return f"sha2({self.text(x)}, 256)" if self.spark else f"sha256({self.text(x)})"

    def hex_text(self, x: str) -> str:
        return f"lower(hex(encode({x}, 'UTF-8')))" if self.spark else f"lower(hex(encode({x})))"

    # --- base -------------------------------------------------------------------------

    def base(self) -> str:
        """One row per event; events of every 19th hour move an hour earlier, leaving gaps."""
        if self.spark:
            k = "CAST(get_json_object(props, '$.k') AS BIGINT)"
            h = "timestampdiff(HOUR, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts)"
            us = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)"
        else:
            k = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
            h = "date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', ts)"
            us = "epoch_us(ts)"
        return (
            f"SELECT event_id, user_id AS u, event_type, {k} AS k, {us} AS us, "
            f"{h} - CASE WHEN {h} % 19 = 7 THEN 1 ELSE 0 END AS h FROM events"
        )

    def day(self, h: str, pattern: tuple[str, str]) -> str:
        days = f"CAST({self.idiv(h, 24)} AS INT)"
        if self.spark:
            day = f"CAST(date_add(DATE '2024-01-01', {days}) AS STRING)"
            return day if pattern[0] == "yyyy-MM-dd" else f"replace({day}, '-', '')"
        return f"strftime(DATE '2024-01-01' + {days}, '{pattern[1]}')"

    # Spark's printf takes microseconds a value, hex and lpad a small part of that.
    def digits(self, x: str, n: int) -> str:
        """A whole number from 0 on with n digits at least."""
        return f"lpad(CAST({x} AS STRING), {n}, '0')" if self.spark else f"printf('%0{n}d', {x})"

    def byte_text(self, x: str) -> str:
        """Two hex digits."""
        return f"lower(lpad(hex({x}), 2, '0'))" if self.spark else f"printf('%02x', {x})"

    def run_id(self, h: str = "h") -> str:
        day = self.day(h, ("yyyyMMdd", "%Y%m%d"))
        return f"{day} || '-' || {self.digits(f'{h} % 24', 2)} || '00' || {self.digits(f'({h} * 7) % 60', 2)}"

    def started(self, h: str = "h") -> str:
        day = self.day(h, ("yyyy-MM-dd", "%Y-%m-%d"))
        return f"{day} || 'T' || {self.digits(f'{h} % 24', 2)} || ':00:' || {self.digits(f'({h} * 7) % 60', 2)} || 'Z'"

    def stamp(self, us: str) -> str:
        """ISO text of microseconds in January 2024."""
        rest = f"({us} - 1704067200000000)"
        hours = self.idiv(rest, 3600000000)
        day = self.day(hours, ("yyyy-MM-dd", "%Y-%m-%d"))
        if self.spark:
            parts = [(f"{hours} % 24", 2), (f"{self.idiv(rest, 60000000)} % 60", 2), (f"{self.idiv(rest, 1000000)} % 60", 2), (f"{rest} % 1000000", 6)]
            hour, minute, second, fraction = (self.digits(*part) for part in parts)
            return f"concat({day}, 'T', {hour}, ':', {minute}, ':', {second}, '.', {fraction}, 'Z')"
        return (
            f"{day} || printf('T%02d:%02d:%02d.%06dZ', {hours} % 24, "
            f"{self.idiv(rest, 60000000)} % 60, {self.idiv(rest, 1000000)} % 60, {rest} % 1000000)"
        )

    # --- cells ------------------------------------------------------------------------

    def octets(self, u: str) -> list[str]:
        f = self.idiv(u, 8)
        parts = (f"({u} * 3) % 256", "16", f"{self.idiv(u, 524288)} % 256",
                 f"{self.idiv(u, 2048)} % 256", f"{f} % 256", f"16 * ({f} % 16) + {u} % 8")
        return [f"CAST({p} AS BIGINT)" for p in parts]

    def mac(self, u: str, sep: str = ":") -> str:
        if self.spark:
            text = f", '{sep}', ".join(f"lpad(hex({o}), 2, '0')" for o in self.octets(u))
            return f"lower(concat({text}))"
        return f"printf('{sep.join(['%02x'] * 6)}', {', '.join(self.octets(u))})"

    @staticmethod
    def ssid_of(u: str) -> str:
        cases = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SSIDS))
        return f"CASE ({u}) % {len(SSIDS)} {cases} END"

    @staticmethod
    def short_of(u: str) -> str:
        """Short-SSID cell of a user's network name; the CRCs are constants of the twelve names."""
        cases = " ".join(
            f"WHEN {i} THEN '0x{zlib.crc32(s.encode()):08x}'" for i, s in enumerate(SSIDS)
        )
        return f"CASE ({u}) % {len(SSIDS)} {cases} END"

    def ssid(self) -> str:
        return f"CASE WHEN k % 5 = 0 THEN '' ELSE {self.ssid_of('u')} END"

    def ssid_hex(self) -> str:
        return (
            "CASE WHEN k % 5 = 0 THEN '<MISSING>' WHEN k % 31 = 4 THEN 'fffe41' "
            f"ELSE {self.hex_text(self.ssid_of('u'))} END"
        )

    band = "CASE k % 3 WHEN 0 THEN '2.4GHz' WHEN 1 THEN '5GHz' ELSE '6GHz' END"
    channel = "CASE k % 3 WHEN 0 THEN 1 + k % 11 WHEN 1 THEN 36 + 4 * (k % 9) ELSE 1 + 4 * (k % 13) END"
    mhz = ("CASE k % 3 WHEN 0 THEN 2412 + 5 * (k % 11) WHEN 1 THEN 5180 + 20 * (k % 9) "
           "ELSE 5955 + 20 * (k % 13) END")
    status = ("CASE event_type WHEN 'click' THEN 'sampled' WHEN 'purchase' THEN 'sampled' "
              "WHEN 'view' THEN 'sampled_empty' WHEN 'signup' THEN 'regulatory_skip' ELSE 'capture_error' END")
    op_class = ("CASE WHEN k % 41 = 0 THEN 'x9' ELSE CASE k % 6 WHEN 0 THEN '81' WHEN 1 THEN '82' "
                "WHEN 2 THEN '115' WHEN 3 THEN '131' WHEN 4 THEN '136' ELSE '200' END END")
    disabled = ("CASE WHEN k % 4 = 2 THEN 'False' WHEN k % 8 = 5 THEN '1' WHEN k % 4 = 1 THEN 'True' END")
    interval = "CASE WHEN k % 17 = 0 THEN NULL WHEN k % 7 = 3 THEN 102 ELSE 100 END"
    rssi = "-(30 + event_id % 60)"

    def pcap(self) -> str:
        return f"'freq-' || {self.text(self.mhz)} || '.pcap'"

    def repeated(self, cond: str, first: str, second: str) -> str:
        """Cell of a neighbor report: NULL without one, two values for every 7th k."""
        return (f"CASE WHEN NOT ({cond}) OR ({first}) IS NULL THEN NULL "
                f"WHEN k % 7 = 0 THEN {self.array(first, second)} ELSE {self.array(first)} END")

    def neighbor_cells(self) -> dict[str, str]:
        t = self.text
        near = "(u + k % 3)"
        return {
            "rnr_op_class": self.repeated(RNR, self.op_class, "'133'"),
            "rnr_channel": self.repeated(RNR, t("1 + k % 11"), "'44'"),
            "rnr_bssid": self.repeated(RNR, self.mac(near, ""), self.mac("(u + 11)", "")),
            "rnr_short_ssid": self.repeated(RNR, self.short_of(near), "'0x00000001'"),
            "rnr_bss_params": self.repeated(RNR, self.parameters(), "'0x80'"),
            "rnr_mld_link_id": self.repeated(f"({RNR}) AND k % 5 = 0", t("k % 4"), "'9'"),
            "rnr_mld_id": self.repeated(f"({RNR}) AND k % 5 = 0", t("k % 3"), "'9'"),
            "rnr_disabled_link": self.repeated(RNR, self.disabled, "'x'"),
        }

    def parameters(self) -> str:
        return f"'0x' || {self.byte_text('(k * 5) % 128')}" if self.spark else "printf('0x%02x', (k * 5) % 128)"

    def epoch(self) -> str:
        seconds, fraction = self.idiv("us", 1000000), "us % 1000000"
        if self.spark:
            return f"concat(CAST({seconds} AS STRING), '.', {self.digits(fraction, 6)}, '000')"
        return f"printf('%d.%06d000', {seconds}, {fraction})"

    def load_cells(self) -> dict[str, str]:
        t = self.text
        def cell(value: str) -> str:
            return (f"CASE WHEN NOT ({LOAD}) THEN NULL WHEN k % 30 = 0 THEN {self.array(t(value), chr(39) + '999' + chr(39))} "
                    f"ELSE {self.array(t(value))} END")
        return {
            "qbss_station_count": cell("event_id % 40"),
            "qbss_utilization": cell("event_id % 256"),
            "qbss_admission": cell("(event_id * 7) % 1000"),
        }

    def radiotap_cells(self) -> dict[str, str]:
        t, a = self.text, self.array
        none = f"CAST(NULL AS {'ARRAY<STRING>' if self.spark else 'VARCHAR[]'})"
        signal = t(self.rssi)
        return {
            "radiotap_tsft": a(t("us")),
            "radiotap_dbm_signal": f"CASE WHEN k % 4 = 0 THEN {a(signal)} ELSE {a(signal, signal, signal)} END",
            "radiotap_db_signal": none,
            "radiotap_noise": none,
            "radiotap_db_noise": none,
            "radiotap_antenna": f"CASE WHEN k % 2 = 0 THEN {a(chr(39) + '0' + chr(39))} END",
            "radiotap_datarate": a("'1.0'"),
            "radiotap_mcs_index": none,
            "radiotap_vht_nss": none,
            "radiotap_he_data1": f"CASE WHEN k % 9 = 0 THEN {a(chr(39) + '2' + chr(39))} END",
            "radiotap_flags_badfcs": f"CASE WHEN k % 25 = 0 THEN {a(chr(39) + 'True' + chr(39))} ELSE {a(chr(39) + 'False' + chr(39))} END",
        }

    # --- relations ----------------------------------------------------------------------

    def frequencies(self) -> str:
        return f"""SELECT {self.run_id()} AS run_id, {self.band} AS band,
            CAST({self.mhz} AS BIGINT) AS frequency_mhz, CAST({self.channel} AS BIGINT) AS channel,
            CASE WHEN event_type = 'signup' AND k % 2 = 0 THEN 'disabled' WHEN k % 4 = 0 THEN 'permitted'
              WHEN k % 4 = 1 THEN 'no-ir' WHEN k % 4 = 2 THEN 'radar' ELSE 'no-ir+radar' END AS regulatory_state,
            {self.status} AS sample_status,
            CAST(CASE WHEN event_type = 'signup' THEN 0 WHEN k % 10 = 9 THEN 20 ELSE 10 END AS BIGINT) AS dwell_seconds,
            CASE WHEN event_type IN ('signup', 'error') THEN '' ELSE {self.pcap()} END AS pcap_file,
            CASE WHEN event_type IN ('signup', 'error') THEN NULL WHEN event_type = 'view' THEN 0
              ELSE 1 + event_id % 5 END AS bssid_count,
            CASE WHEN event_type IN ('signup', 'error') THEN NULL WHEN event_type = 'view' THEN 0
              ELSE 1 + event_id % 120 END AS beacon_count,
            CASE WHEN event_type = 'error' THEN 'capture stopped' WHEN event_type <> 'signup' THEN ''
              WHEN k % 2 = 0 THEN 'disabled by regulatory state' ELSE 'tuning refused' END AS error
            FROM ev"""

    def observations(self) -> str:
        beacons = "(1 + event_id % 120)"
        weak = "k % 19 = 0"
        return f"""SELECT {self.run_id()} AS run_id, {self.band} AS band,
            CAST({self.mhz} AS BIGINT) AS frequency_mhz, CAST({self.channel} AS BIGINT) AS channel,
            {self.mac('u')} AS bssid, {self.ssid()} AS ssid, {beacons} AS beacons,
            CAST({self.interval} AS BIGINT) AS beacon_interval_tu,
            CASE WHEN {weak} THEN NULL ELSE {self.rssi} - 2 * (k % 9) END AS rssi_min_dbm,
            CASE WHEN {weak} THEN NULL ELSE CAST({self.rssi} AS DOUBLE) + CAST(k % 2 AS DOUBLE) / 2 END AS rssi_mean_dbm,
            CASE WHEN {weak} THEN NULL ELSE {self.rssi} + k % 9 END AS rssi_max_dbm,
            {self.stamp('us')} AS first_seen, {self.stamp(f'(us + {beacons} * 102400)')} AS last_seen,
            CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(event_id % 150 AS DOUBLE) / 128 END AS beacon_reception_ratio
            FROM ev"""

    def ids(self, table: dict[int, str]) -> str:
        return self.compact(*[f"CASE WHEN {cond} THEN CAST({n} AS INT) END" for n, cond in table.items()])

    def frames(self) -> str:
        cells = {**self.neighbor_cells(), **self.load_cells(),
                 "he_bss_color": f"CASE WHEN {EXTS[36]} THEN {self.array(self.text('k % 64'))} END",
                 **self.radiotap_cells()}
        # A hidden name is no text; every 61st run has frames without an address.
        return f"""SELECT {self.run_id()} AS run_id, {self.pcap()} AS pcap_file, event_id + 1 AS frame_number,
            {self.epoch()} AS frame_time_epoch,
            CAST(200 + k AS BIGINT) AS captured_length,
            CAST(200 + k + CASE WHEN k % 29 = 0 THEN 10 ELSE 0 END AS BIGINT) AS wire_length,
            CASE WHEN h % 61 = 10 AND k % 10 = 3 THEN NULL ELSE {self.mac('u')} END AS bssid,
            {self.ssid_hex()} AS ssid_hex, {self.ssid()} AS ssid_text,
            CAST(CASE WHEN k % 17 = 0 THEN 0 WHEN k % 7 = 3 THEN 102 ELSE 100 END AS BIGINT) AS interval_tu,
            {self.text('us')} AS beacon_timestamp,
            CAST(CASE WHEN k % 19 = 0 THEN NULL ELSE {self.rssi} END AS BIGINT) AS rssi_dbm,
            {self.ids(TAGS)} AS tags, {self.ids(EXTS)} AS exts,
            {', '.join(f'{sql} AS {name}' for name, sql in cells.items())},
            {self.text('NULL')} AS error FROM ev"""

    def captures(self) -> str:
        """Capture files with their sizes; a run-frequency with only empty dwells is a bare header."""
        return f"""SELECT run_id, pcap_file, CAST(24 + sum(size) AS BIGINT) AS length FROM (
            SELECT {self.run_id()} AS run_id, {self.pcap()} AS pcap_file,
              CASE WHEN event_type = 'view' THEN 0 ELSE 216 + k END AS size FROM ev) x
            GROUP BY run_id, pcap_file"""

    def runs(self) -> str:
        """One row per run hour with the attempt it stands for."""
        status = ("CASE WHEN h % 13 = 5 THEN 'skipped_no_interface' WHEN h % 17 = 3 THEN 'failed' "
                  "WHEN h % 23 = 11 THEN 'running' WHEN h % 29 = 13 THEN 'paused' ELSE 'sweep' END")
        doc = (f"'{{\"schema\":\"instrument/1\",\"run_status\":\"' || {status} || '\",\"started_utc\":\"' || "
               f"{self.started()} || '\",\"interface_present\":true,\"usb\":{{\"bus\":\"1\"}}}}'")
        return f"""SELECT h, n, beacons, {self.run_id()} AS run_id,
            CASE WHEN h % 41 = 9 THEN 'note-' || {self.run_id()} ELSE {self.run_id()} END AS name,
            h % 37 <> 6 AS is_dir, {status} AS run_status, {self.started()} AS started_utc,
            CASE WHEN h % 31 = 9 THEN NULL WHEN h % 31 = 12 THEN '{{not json' WHEN h % 31 = 14 THEN '[1]' ELSE {doc} END AS document,
            h % 31 NOT IN (9, 12, 14) AS instrument_ok,
            h % 43 <> 8 AS frequencies_ok, h % 47 <> 9 AS aggregate_ok,
            CASE WHEN h % 53 = 14 THEN 'partial' WHEN h % 59 = 8 THEN 'failed' ELSE 'succeeded' END AS status,
            CASE WHEN h % 67 = 3 THEN 'survey-derived/0' ELSE '{SERIES.derived_schema_id}' END AS schema_id,
            CASE WHEN h % 71 = 15 THEN 'old' ELSE '{SERIES.extractor_version}' END AS extractor_version,
            h % 73 <> 10 AS has_manifest
            FROM (SELECT h, count(*) AS n, CAST(sum(1 + event_id % 120) AS BIGINT) AS beacons FROM ev GROUP BY h) g"""


SPARK = Dialect("spark")
DUCK = Dialect("duckdb")

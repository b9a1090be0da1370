"""Capture bytes and run folders for tests, with invented addresses and names."""

from __future__ import annotations

import json
import struct
from pathlib import Path

FREQ_HEADER = ("band\tfrequency_mhz\tchannel\tregulatory_state\tsample_status\tdwell_seconds\t"
               "pcap_file\tbssid_count\tbeacon_count\terror")
AGG_HEADER = ("band\tfrequency_mhz\tchannel\tbssid\tssid\tbeacons\tbeacon_interval_tu\trssi_min_dbm\t"
              "rssi_mean_dbm\trssi_max_dbm\tfirst_seen\tlast_seen\tbeacon_reception_ratio")
AP1, AP2, AP3, AP4 = "aa:bb:cc:00:11:22", "dd:ee:ff:00:22:33", "11:22:33:44:55:66", "60:70:80:00:33:44"
BASE = 1_787_000_000


def element(tag: int, payload: bytes) -> bytes:
    return bytes((tag, len(payload))) + payload


def extension(number: int, payload: bytes = b"\0") -> bytes:
    return element(255, bytes((number,)) + payload)


def load(stations: int, busy: int, admission: int) -> bytes:
    return element(11, struct.pack("<HBH", stations, busy, admission))


def neighbor(address: str, short: int, params: int = 0, mld: tuple[int, int, bool] | None = None) -> bytes:
    entry = b"\xff" + bytes.fromhex(address) + struct.pack("<IBB", short, params, 0)
    if mld:
        number, link, off = mld
        entry += bytes((number, link, 0x20 if off else 0))
    return entry


def report(op_class: int, channel: int, *entries: bytes) -> bytes:
    return element(201, bytes(((len(entries) - 1) << 4, len(entries[0]), op_class, channel)) + b"".join(entries))


def radiotap(signal: int | None = None) -> bytes:
    if signal is None:
        return struct.pack("<BBHIB", 0, 0, 9, 1 << 1, 0)
    return struct.pack("<BBHIBb", 0, 0, 10, 1 << 1 | 1 << 5, 0, signal)


def beacon(address: str, elements: bytes, interval: int = 100, signal: int | None = None,
           source: str | None = None, subtype: int = 8) -> bytes:
    bssid = bytes.fromhex(address.replace(":", ""))
    sender = bytes.fromhex((source or address).replace(":", ""))
    header = bytes((subtype << 4, 0, 0, 0)) + b"\xff" * 6 + sender + bssid + b"\0\0"
    return radiotap(signal) + header + struct.pack("<QHH", 0, interval, 0x11) + elements


def capture(packets, order: str = "<", nano: bool = False, link: int = 127) -> bytes:
    magic = 0xA1B23C4D if nano else 0xA1B2C3D4
    out = struct.pack(order + "IHHiIII", magic, 2, 4, 0, 0, 262144, link)
    for seconds, fraction, packet in packets:
        out += struct.pack(order + "IIII", seconds, fraction, len(packet), len(packet)) + packet
    return out


def sample_capture() -> bytes:
    common = (element(0, b"TestNet") + element(3, b"\1") + load(7, 42, 300)
              + report(81, 3, neighbor("000000112233", 0x12345678, 0x0A))
              + extension(35) + extension(108) + extension(106) + extension(107))
    mesh_two = element(0, b"Mesh") + report(
        129, 37, neighbor("000000aabbcc", 0xAABBCCDD, 4), neighbor("000000112244", 0x11223344))
    mesh_off = element(0, b"Mesh") + report(
        131, 5, neighbor("000000556677", 0x55667788, 0, (3, 2, True)))
    return capture([
        (BASE, 250_000, beacon(AP1, common)),
        (BASE + 5, 250_000, beacon(AP1, common + extension(59))),
        (BASE + 9, 750_000, beacon(AP2, mesh_two)),
        (BASE + 9, 800_000, beacon(AP2, mesh_off)),
        (BASE + 9, 900_000, beacon(AP3, element(0, b"NoRnr"))),
        (BASE + 9, 950_000, beacon(AP4, element(0, b"SixGhzAdv")
                                   + report(131, 5, neighbor("000000607080", 0x60708090)))),
    ])


def write_run(root: Path, run_id: str, status: str | None = "sweep", tables: bool = True,
              with_capture: bool = True, document: str | None = None) -> Path:
    folder = Path(root) / run_id
    folder.mkdir(parents=True)
    if document is not None:
        (folder / "instrument.json").write_text(document)
    elif status is not None:
        (folder / "instrument.json").write_text(json.dumps(
            {"schema": "instrument/1", "run_status": status, "skip_reason": None,
             "started_utc": f"{run_id[:4]}-{run_id[4:6]}-{run_id[6:8]}T{run_id[9:11]}:00:03Z",
             "interface_present": True}))
    if tables:
        (folder / "frequencies.tsv").write_text("\n".join([
            FREQ_HEADER,
            "2.4GHz\t2412\t1\tpermitted\tsampled\t10\tfreq-2412.pcap\t4\t5\t",
            "2.4GHz\t2437\t6\tpermitted\tsampled_empty\t10\tfreq-2437.pcap\t0\t0\t",
            "6GHz\t5955\t1\tno-ir\tsampled_empty\t10\tfreq-5955.pcap\t0\t0\t"]) + "\n")
        seen = "2026-08-27T13:00:03.459251Z\t2026-08-27T13:00:08.265788Z"
        (folder / "aggregate.tsv").write_text("\n".join([
            AGG_HEADER,
            f"2.4GHz\t2412\t1\t{AP1.upper()}\tTestNet\t2\t100\t-70\t-69.5\t-69\t{seen}\t0.200",
            f"2.4GHz\t2412\t1\t{AP2}\t\"Mesh\t1\t100\t-80\t-80.0\t-80\t{seen}\t0.100",
            f"2.4GHz\t2412\t1\t{AP3}\t\t1\t\t-90\t-89.0\t-89\t{seen}\t0.100",
            f"2.4GHz\t2412\t1\t{AP4}\tSixGhzAdv\t1\t100\t-75\t-75.0\t-75\t{seen}\t0.100"]) + "\n")
    if with_capture:
        (folder / "freq-2412.pcap").write_bytes(sample_capture())
        for mhz in (2437, 5955):
            (folder / f"freq-{mhz}.pcap").write_bytes(capture([]))
    return folder

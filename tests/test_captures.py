import pytest
from pyspark.sql import functions as F

from quietband import schemas
from quietband.operators import census as K
from quietband.operators import enrichment as E
from quietband.sources import captures as CAP
from tests import capture_bytes as B


def decode(spark, *files):
    rows = [("20260827-090003", name, len(data), bytearray(data)) for name, data in files]
    return CAP.decode_captures(
        spark.createDataFrame(rows, "run_id string, pcap_file string, length bigint, content binary"))


@pytest.fixture(scope="module")
def frames(spark):
    return decode(spark, ("freq-2412.pcap", B.sample_capture()), ("freq-2437.pcap", B.capture([]))).cache()


def test_one_row_per_beacon(frames):
    rows = frames.orderBy("frame_number").collect()
    assert [r.frame_number for r in rows] == [1, 2, 3, 4, 5, 6]
    assert rows[0].bssid == B.AP1 and rows[0].frame_time_epoch == "1787000000.250000000"
    assert rows[0].tags == [0, 3, 11, 201] and rows[1].exts == [35, 108, 106, 107, 59]
    assert rows[2].rnr_op_class == ["129"] and rows[2].rnr_short_ssid == ["0xaabbccdd", "0x11223344"]
    assert rows[3].rnr_disabled_link == ["True"] and rows[3].rnr_mld_id == ["3"] and rows[3].rnr_mld_link_id == ["2"]


def test_capabilities(frames):
    caps = {r.bssid: r for r in E.ie_capabilities(frames).collect()}
    ap1, ap3 = caps[B.AP1], caps[B.AP3]
    assert ap1.has_he and ap1.has_he_6ghz and ap1.has_eht and ap1.has_mld and ap1.has_rnr and ap1.has_bss_load
    assert ap1.ext_elements == "35,59,106,107,108" and ap1.elements == "0,3,11,201"
    assert ap3.elements == "0" and ap3.ext_elements == "" and not ap3.has_rnr


def test_neighbor_records(frames):
    rows = E.rnr_records(frames).orderBy("frame_number").collect()
    assert [r.tx_bssid for r in rows] == [B.AP1, B.AP1, B.AP2, B.AP2, B.AP4]
    for r in rows[:2]:
        assert (r.structure_status, r.target_band, r.target_frequency_mhz) == ("single_occurrence", "2.4GHz", 2422)
        assert r.neighbor_bssid == "00:00:00:11:22:33" and r.raw_neighbor_bssid == "000000112233"
    two = rows[2]
    assert two.structure_status == "unpaired_multi_occurrence" and two.target_band is None
    assert "," in two.raw_short_ssid and two.unpaired_fields == "rnr_bssid,rnr_short_ssid,rnr_bss_params"
    assert rows[3].target_band == "6GHz" and rows[3].disabled_link == "True"
    assert (rows[4].target_band, rows[4].target_frequency_mhz) == ("6GHz", 5975)


def test_neighbor_cells_of_unresolved_fields_stay_null(frames):
    row = E.rnr_records(frames, ()).first()
    assert row.field_resolution_state == "unresolved_candidates" and row.op_class is None


def test_load_records(frames):
    rows = E.bss_load_records(frames).collect()
    assert len(rows) == 2
    assert {(r.bssid, r.station_count, r.utilization, r.admission_capacity, r.raw_utilization) for r in rows} == {
        (B.AP1, 7, 42, 300, "42")}


def test_census(frames):
    elements = {(r.namespace, r.element): (r.frames, r.bssids, r.name) for r in K.element_census(frames).collect()}
    assert elements[("element", 0)] == (6, 4, "SSID") and elements[("element", 201)][:2] == (5, 3)
    assert elements[("extension", 59)] == (1, 1, "HE 6 GHz Band Capabilities")
    absent = {r.element for r in K.absent_priority_elements(frames).collect()}
    assert absent == {71, 48, 255, 127, 45, 191}
    assert K.generations_advertised(frames).first().generations == "HE / Wi-Fi 6, HE 6 GHz / Wi-Fi 6E, EHT / Wi-Fi 7"
    rnr = E.rnr_records(frames)
    assert K.ambiguous_reports(rnr).first().skipped_ambiguous == 1
    outcomes = {r.neighbor_bssid: r.outcome for r in
                K.neighbor_outcomes(K.advertisements(rnr), K.observed_names(frames)).collect()}
    assert outcomes == {"00:00:00:11:22:33": K.NOT_OBSERVED, "00:00:00:55:66:77": K.LINK_DISABLED,
                        "00:00:00:60:70:80": K.NOT_OBSERVED}
    counts = {r.check: r.frames for r in K.identity_counts(frames).collect()}
    assert counts["element_201_rnr"] == 5 and counts["any_extension_element"] == 2
    assert counts["rnr_mld_link_id"] == 1 and counts["fcs_failures"] == 0


def test_least_frequent_advertisement_speaks(spark):
    on = B.element(0, b"x") + B.report(131, 5, B.neighbor("000000556677", 1))
    off = B.element(0, b"x") + B.report(131, 5, B.neighbor("000000556677", 1, 0, (3, 2, True)))
    frames = decode(spark, ("freq-2412.pcap", B.capture(
        [(B.BASE, i, B.beacon(B.AP1, e)) for i, e in enumerate((off, on, on))])))
    rnr = E.rnr_records(frames)
    assert K.neighbor_outcomes(K.advertisements(rnr), K.observed_names(frames)).first().outcome == K.LINK_DISABLED


def test_address_three_and_stamps(spark):
    data = B.capture([(0, 0, B.beacon("aa:bb:cc:dd:ee:ff", B.element(0, b"a\tb"), source="02:11:22:33:44:55", signal=-61)),
                      (2, 500_000, B.beacon("aa:bb:cc:dd:ee:ff", B.element(0, b""), interval=0, signal=-60)),
                      (3, 0, B.beacon(B.AP3, b"", subtype=5))])
    frequencies = spark.createDataFrame(
        [("20260827-090003", "freq-2412.pcap", 2412, 1, 10)],
        "run_id string, pcap_file string, frequency_mhz bigint, channel bigint, dwell_seconds bigint")
    row, = E.beacon_summary(decode(spark, ("freq-2412.pcap", data)), frequencies).collect()
    assert row.bssid == "aa:bb:cc:dd:ee:ff" and row.ssid == "a b" and row.beacons == 2
    assert (row.first_seen, row.last_seen) == ("1970-01-01T00:00:00.000000Z", "1970-01-01T00:00:02.500000Z")
    assert (row.rssi_min_dbm, row.rssi_mean_dbm, row.rssi_max_dbm) == (-61, -60.5, -60)
    assert row.beacon_interval_tu == 100 and row.beacon_reception_ratio == 0.02
    assert row.band == "2.4GHz" and row.channel == 1


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("nano", [False, True])
def test_four_magics(spark, order, nano):
    data = B.capture([(5, 7, B.beacon(B.AP1, B.element(0, b"n")))], order, nano)
    row = decode(spark, ("freq-2412.pcap", data)).first()
    assert row.frame_time_epoch == ("5.000000007" if nano else "5.000007000") and row.error is None


@pytest.mark.parametrize("data, problem", [
    (B.sample_capture()[:-3], "truncated"),
    (B.capture([(0, 0, b"\0" * 40)], link=1), "link type 1"),
    (b"junkjunk" * 8, "magic"),
])
def test_unreadable_capture_is_one_error_row(spark, data, problem):
    frames = decode(spark, ("freq-2412.pcap", data), ("freq-2437.pcap", B.sample_capture()))
    bad = frames.where("error is not null").collect()
    assert len(bad) == 1 and problem in bad[0].error
    # Its run loses the advanced surface, the other capture included.
    assert E.identified_frames(frames).count() == 0
    assert E.identity_errors(frames).count() == 1


def test_element_cut_by_the_capture_ends_the_walk(spark):
    data = B.capture([(0, 0, B.beacon(B.AP1, B.element(0, b"ok") + bytes((45, 20)) + b"abc"))])
    row = decode(spark, ("freq-2412.pcap", data)).first()
    assert row.tags == [0] and row.ssid_hex == "6f6b"


def test_only_sizes_are_read_to_count_captures(spark, tmp_path):
    B.write_run(tmp_path, "20260827-090003")
    files = CAP.capture_files(spark, f"{tmp_path}/*/")
    row = K.capture_counts(files).first()
    assert (row.populated_captures, row.captures) == (1, 3)
    plan = CAP.populated(files).select("pcap_file")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(length,24)" in plan and "content" not in plan


def test_a_long_capture_leaves_in_batches(spark, tmp_path):
    """One file of many frames, read packet by packet from its path; a cut one gives an error and no observation."""
    one = B.capture([(0, 0, B.beacon(B.AP1, B.element(0, b"ok")))])
    head, packet = one[:24], one[24:]
    run = tmp_path / "20260827-090003"
    run.mkdir()
    (run / "freq-2412.pcap").write_bytes(head + packet * 30_000)
    (run / "freq-2437.pcap").write_bytes(head + packet * 10_000 + packet[:-2])
    frames = CAP.decode_captures(CAP.capture_files(spark, f"{tmp_path}/*/")).cache()
    assert frames.where("pcap_file = 'freq-2412.pcap'").count() == 30_000
    assert frames.where("error is not null").count() == 1
    row, = E.beacon_summary(frames, spark.createDataFrame([], schemas.FREQUENCIES)).collect()
    assert (row.frequency_mhz, row.band, row.beacons, row.channel) == (2412, "2.4GHz", 30_000, None)


def test_one_large_capture_is_read_by_several_tasks(spark, tmp_path):
    """Pieces begin and end between packets; together they hold every packet once, numbered through the file."""
    one = B.capture([(7, 5, B.beacon(B.AP1, B.element(0, b"ok")))])
    run = tmp_path / "20260827-090003"
    run.mkdir()
    (run / "freq-2412.pcap").write_bytes(one[:24] + one[24:] * 200_000)
    captures = CAP.capture_files(spark, f"{tmp_path}/*/")
    pieces = CAP.packet_index(captures).orderBy("start").collect()
    assert len(pieces) > 2 and [p.start for p in pieces[1:]] == [p.stop for p in pieces[:-1]] and pieces[-1].stop == 24 + len(one[24:]) * 200_000
    packets = CAP.read_packets(captures).withColumn("task", F.spark_partition_id())
    row = packets.agg(F.count("*").alias("n"), F.countDistinct("frame_number").alias("numbers"), F.max("frame_number").alias("last"),
                      F.countDistinct("task").alias("tasks"), F.min("frame_time_epoch").alias("time")).first()
    assert (row.n, row.numbers, row["last"], row.time) == (200_000, 200_000, 200_000, "7.000005000") and row.tasks > 1


def test_a_file_that_the_store_does_not_give_is_an_error_row(spark, tmp_path):
    B.write_run(tmp_path, "20260827-090003")
    listed = CAP.capture_files(spark, f"{tmp_path}/*/").withColumn("path", F.regexp_replace("path", "2412", "9999"))
    row, = CAP.read_packets(listed).collect()
    assert row.packet is None and row.error.startswith("freq-2412.pcap: ")


def test_names_that_are_no_text(spark):
    """Bytes that are no UTF-8 become replacement characters, as in other decoders; the hex keeps them."""
    names = [b"\xff\xfeA", b"caf\xc3\xa9", b"\xf0\x9f\x98", b"a\xc3", b"\xe2\x82\xac\r\n"]
    data = B.capture([(i, 0, B.beacon(B.AP1, B.element(0, n))) for i, n in enumerate(names)])
    rows = decode(spark, ("freq-2412.pcap", data)).orderBy("frame_number").collect()
    assert [r.ssid_hex for r in rows] == [n.hex() for n in names]
    assert [r.ssid_text for r in rows] == [n.decode("utf-8", "replace").translate({9: " ", 10: " ", 13: " "}) for n in names]


def test_radiotap_fields_in_order_and_alignment(spark):
    """Two presence words, aligned fields, an unsigned time above 63 bits, and a check sequence that is no element."""
    import struct

    words = struct.pack("<II", 1 << 0 | 1 << 1 | 1 << 2 | 1 << 5 | 1 << 31, 1 << 5 | 1 << 11 | 1 << 19 | 1 << 23)
    fields = struct.pack("<4xQBBb", 2**63 + 5, 0x50, 11, -40) + struct.pack("<bB", -50, 3) + bytes((7, 8, 9)) + struct.pack("<HHHHHH", 2, 0, 0, 0, 0, 0)
    size = 4 + len(words) + len(fields)
    body = B.beacon(B.AP2, B.element(0, b"n") + B.element(45, b"x"))[len(B.radiotap()):]
    packet = struct.pack("<BBH", 0, 0, size) + words + fields + body + bytes((48, 0, 48, 0))
    row, = decode(spark, ("freq-2412.pcap", B.capture([(0, 0, packet)]))).collect()
    assert row.tags == [0, 45] and row.rssi_dbm == -40 and row.radiotap_tsft == [str(2**63 + 5)]
    assert (row.radiotap_flags_badfcs, row.radiotap_datarate, row.radiotap_dbm_signal) == (["True"], ["5.5"], ["-40", "-50"])
    assert (row.radiotap_antenna, row.radiotap_mcs_index, row.radiotap_he_data1) == (["3"], ["9"], ["2"])
    assert row.radiotap_noise is None and row.captured_length == len(packet) and row.beacon_timestamp == "0"

import pytest
from pyspark.sql import functions as F

from quietband.functions import cells, names, radio, times
from quietband.operators import census as K
from quietband.operators import health as H
from quietband.operators import metrics as V
from quietband.operators import profile as P
from quietband.sources import exports as OUT
from quietband.sources import survey_files as SRC


def value(spark, column, **inputs):
    kinds = {str: "string", int: "bigint", float: "double", list: "array<int>"}
    ddl = ", ".join(f"{n} {kinds.get(type(v), 'string')}" for n, v in inputs.items())
    return spark.createDataFrame([tuple(inputs.values())], ddl).select(column.alias("v")).first().v


@pytest.mark.parametrize("text, want", [
    ("aabbccddeeff", "aa:bb:cc:dd:ee:ff"), ("AA-BB-CC-DD-EE-FF", "aa:bb:cc:dd:ee:ff"),
    ("aa:bb:cc:dd:ee", "aa:bb:cc:dd:ee"), ("GGbbccddeeff", "GGbbccddeeff"), (None, None)])
def test_canonical_mac(spark, text, want):
    assert value(spark, radio.canonical_mac(F.col("x")), x=text) == want


@pytest.mark.parametrize("cell, want", [
    ("", "<hidden>"), (None, "<hidden>"), ("<MISSING>", "<hidden>"), ("4d657368", "Mesh"),
    ("fffe41", "<hex:fffe41>"), ("c3a9", "é"), ("4d6", "<hex:4d6>"), ("zz", "<hex:zz>")])
def test_decode_ssid(spark, cell, want):
    assert value(spark, names.decode_ssid(F.col("x")), x=cell) == want


@pytest.mark.parametrize("op, ch, band, mhz", [
    (81, 1, "2.4GHz", 2412), (82, 14, "2.4GHz", 2484), (84, 6, "2.4GHz", 2437), (115, 36, "5GHz", 5180),
    (131, 5, "6GHz", 5975), (136, 2, "6GHz", 5935), (137, 1, "6GHz", 5955), (138, 1, "unknown", None), (85, 1, "unknown", None)])
def test_operating_classes(spark, op, ch, band, mhz):
    row = spark.range(1).select(
        radio.opclass_band(F.lit(op)).alias("b"), radio.opclass_mhz(F.lit(op), F.lit(ch)).alias("m")).first()
    assert (row.b, row.m) == (band, mhz)


@pytest.mark.parametrize("text, want", [
    ("(30.0 dBm)", "permitted"), ("(12.0 dBm) (no IR)", "no-ir"), ("(disabled)", "disabled"),
    ("(20.0 dBm) (no IR) (radar detection)", "no-ir+radar"), ("(some new flag)", "some-new-flag"), ("", "permitted")])
def test_regulatory_state(spark, text, want):
    assert value(spark, radio.regulatory_state(F.col("x")), x=text) == want


@pytest.mark.parametrize("ssid, provider, default, shared", [
    ("SPECTRUMSETUP-1", "charter_spectrum", True, False), ("netgear", "netgear_oem", True, False),
    ("NETGEAR-5G", None, False, False), ("xfinitywifi", "comcast_community", True, True),
    ("Spectrum Mobile", "charter_community", False, True), ("", None, False, False)])
def test_classify_ssid(spark, ssid, provider, default, shared):
    found = names.classify(F.col("x"))
    row = spark.createDataFrame([(ssid,)], "x string").select(*[c.alias(n) for n, c in found.items()]).first()
    assert (row.provider_family, row.isp_default, row.shared_service, row.hidden) == (provider, default, shared, ssid == "")


def test_cells(spark):
    assert value(spark, cells.long_cell(F.col("x")), x=" 7 ") == 7
    assert value(spark, cells.long_cell(F.col("x")), x="10.0") is None
    assert value(spark, cells.text_cell(F.col("x")), x=None) == ""
    assert value(spark, cells.int_set(F.col("x")), x="201,3,x,,3, 11") == [3, 11, 201]


@pytest.mark.parametrize("ids", [[], [0], [255], [63, 64, 127], [7, 8, 191, 192, 254, 255], list(range(256))])
def test_sets_held_as_words(spark, ids):
    """Texts and flags come from the words, the sign bit of a word included."""
    words = cells.bit_words(F.col("x"))
    assert value(spark, cells.bit_text(words), x=ids) == ",".join(map(str, ids))
    for wanted in ((0,), (63,), (255, 3), (8, 100)):
        assert value(spark, cells.bits_overlap(words, wanted), x=ids) == bool(set(wanted) & set(ids))


def test_address_bits(spark):
    assert value(spark, radio.is_locally_administered(F.col("x")), x="02:00:00:00:00:00")
    assert value(spark, radio.is_multicast(F.col("x")), x="01:00:00:00:00:00")
    assert value(spark, radio.oui(F.col("x")), x="AA:BB:CC:00:00:00") is None
    assert value(spark, radio.oui(F.col("x")), x="A8:BB:CC:00:00:00") == "a8:bb:cc"
    assert value(spark, radio.radio_family(F.col("x")), x="AA:BB:CC:DD:EE:F1") == "bb:cc:dd:ee:f_"


def test_ratio_is_not_clamped(spark):
    assert value(spark, radio.reception_ratio(F.lit(100), F.lit(10), F.col("x")), x=100) == 1.024
    assert value(spark, radio.reception_ratio(F.lit(100), F.lit(10), F.col("x")), x=0) is None


def test_bss_parameter_names(spark):
    assert value(spark, radio.bss_parameter_names(F.col("x")), x="0x0a") == ["same SSID", "transmitted BSSID"]
    assert value(spark, radio.bss_parameter_names(F.col("x")), x="0x00") == []
    assert value(spark, radio.bss_parameter_names(F.col("x")), x="n/a") is None


@pytest.mark.parametrize("run_id, hour, slot", [
    ("20260827-093015", "2026-08-27 09:00:00", "20260827-090000"), ("20261327-090000", None, None), ("note", None, None)])
def test_run_hours(spark, run_id, hour, slot):
    assert value(spark, times.run_hour(F.col("x")).cast("string"), x=run_id) == hour
    assert value(spark, times.slot_of(F.col("x")), x=run_id) == slot


def test_short_ssid_collision_is_deterministic(spark):
    observed = spark.createDataFrame(
        [("r", "a", "Mesh"), ("r", "b", "<hidden>"), ("r", "c", "<hex:ff>"), ("r", "d", "")], "run_id string, bssid string, ssid string")
    assert [r.neighbor_ssid for r in K.name_pool(observed).collect()] == ["Mesh"]


def test_null_neighbor_counts_nowhere_but_stays_ambiguous(spark):
    rnr = spark.createDataFrame(
        [("r", "t", None, "single_occurrence", "6GHz", None), ("r", "t", "n", "single_occurrence", "6GHz", "1"),
         ("r", "t", "m", "single_occurrence", "6GHz", None), ("r", "t", "m", "unpaired_multi_occurrence", None, None)],
        "run_id string, tx_bssid string, neighbor_bssid string, structure_status string, target_band string, disabled_link string")
    observations = spark.createDataFrame([("r", "m", "2.4GHz", 3), ("r", "q", "6GHz", 4)], "run_id string, bssid string, band string, beacons bigint")
    row = V.address_evidence(observations, rnr).first()
    assert (row.direct_bssids, row.direct_beacons, row.advertised_6ghz_neighbors, row.advertised_6ghz_disabled_links) == (1, 4, 2, 1)
    # The only enabled neighbor was heard, on another band.
    assert (row.ambiguous_rnr_rows, row.advertised_not_observed_nonconcurrent) == (1, 0)


def test_profile_of_an_empty_sweep(spark):
    from quietband import schemas
    from quietband.plans.profile import profile_sweeps

    freq = spark.createDataFrame(
        [("r", "6GHz", 5955, 1, "no-ir", "sampled_empty", 10, "f.pcap", 0, 0, "")], schemas.FREQUENCIES)
    parts = profile_sweeps(freq, schemas.empty(spark, "observations"))
    assert parts["coverage"].first().attempted == 1 and parts["features"].count() == 0
    control = parts["positive_control"].first()
    assert (control.verdict, control.regulatory_states) == ("unvalidated", "no-ir")
    assert parts["reception_bounds"].count() == 0 and parts["ssid_profile"].count() == 0
    assert [r.flag for r in parts["quality_flags"].collect()] == ["capture_errors"]


def test_text_tables_keep_quotes_and_blanks(spark, tmp_path):
    rows = spark.createDataFrame([("20260827-090003", '"x" y', None), ("20260827-090003", "", "\\n")], "run_id string, ssid string, note string")
    OUT.write_tsv(rows, str(tmp_path / "t"))
    lines = [p.read_text() for p in (tmp_path / "t").glob("*.csv")]
    body = sorted(line for text in lines for line in text.splitlines()[1:])
    assert body == sorted(['20260827-090003\t"x" y\t', "20260827-090003\t\t\\n"])


def test_phy_lines_first_wins(spark):
    lines = spark.createDataFrame(
        [("r", 1, "\t\t* 5955.0 MHz [1] (12.0 dBm) (no IR)"), ("r", 2, "\t\t* 5955.0 MHz [1] (30.0 dBm)"),
         ("r", 3, "\t\t* 2412 MHz [1] (30.0 dBm)"), ("r", 4, "Bitrates (non-HT):"), ("r", 5, "\t\t* 5180.0 MHz [36] (disabled)")],
        "run_id string, line_no bigint, line string")
    rows = SRC.phy_frequency_table(lines, ("2.4GHz", "6GHz")).orderBy("frequency_mhz").collect()
    assert [(r.band, r.frequency_mhz, r.channel, r.regulatory_state) for r in rows] == [
        ("2.4GHz", 2412, 1, "permitted"), ("6GHz", 5955, 1, "no-ir")]


def test_clock_before_start_expects_nothing(spark):
    from datetime import datetime

    from quietband import SeriesConfig
    assert H.expected_slots(H.clock(spark, datetime(2026, 8, 27, 8)), SeriesConfig("20260827-090003", ("20260827-054734", "20260827-060013"))).count() == 0


def test_modal_interval_prefers_the_smallest_tie(spark):
    rows = spark.createDataFrame([("r", 102), ("r", 100), ("r", 102), ("r", 100), ("r", None)], "run_id string, v bigint")
    assert P._modal(rows, "v").first().v == 100


def test_exact_median_across_buckets(spark):
    import random
    import statistics

    from quietband.operators import briefing as B
    for size in (1, 2, 7, 400, 401):
        values = [random.Random(size).randrange(0, 5000) for _ in range(size)]
        rows = spark.createDataFrame([("m", v) for v in values], "measure string, v bigint")
        assert B._medians(rows).first().median == statistics.median(values)


def test_neighbor_state_agrees_with_the_fused_evidence(spark):
    import random
    rng = random.Random(3)
    rnr = spark.createDataFrame(
        [(f"r{rng.randrange(3)}", rng.choice(["t", "u", None]), rng.choice(["a", "b", "c", None]),
          rng.choice(["single_occurrence", "unpaired_multi_occurrence"]), rng.choice(["6GHz", "unknown", "5GHz", None]),
          rng.choice([None, "1", "False"])) for _ in range(200)],
        "run_id string, tx_bssid string, neighbor_bssid string, structure_status string, target_band string, disabled_link string")
    obs = spark.createDataFrame(
        [(f"r{rng.randrange(3)}", rng.choice("abxyz"), rng.choice(["6GHz", "5GHz"]), 2) for _ in range(12)],
        "run_id string, bssid string, band string, beacons bigint")
    names = ["advertised_6ghz_neighbors", "advertised_6ghz_disabled_links", "unresolved_operating_classes", "ambiguous_rnr_rows"]
    fused = {r.run_id: r for r in V.address_evidence(obs, rnr).collect()}
    for r in V.neighbor_state(rnr).collect():
        assert [r[n] for n in names] == [fused[r.run_id][n] for n in names]
    unheard = {r.run_id: r[1] for r in V.not_observed_counts(rnr, obs).collect()}
    assert {k: v.advertised_not_observed_nonconcurrent for k, v in fused.items() if v.advertised_not_observed_nonconcurrent} == unheard

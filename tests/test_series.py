"""A run tree from files to views and briefing, incremental behaviour included."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quietband import config as C
from quietband.config import SeriesConfig
from quietband.operators import health as H
from quietband.operators import incremental as I
from quietband.plans import tree
from quietband.plans.briefing import briefing
from quietband.plans.enrich import enrich
from quietband.plans.update import plan_update, update
from quietband.plans.views import build_views
from quietband.sources import derived as D
from tests import capture_bytes as B

SERIES = SeriesConfig("20260827-130000", ("20260827-054734", "20260827-060013"))
NOW = datetime(2026, 8, 27, 17, 30)
SWEEP, SECOND, SKIP, FAIL = (f"20260827-{h}0003" for h in ("13", "14", "15", "16"))


def build_tree(root):
    B.write_run(root, SWEEP)
    B.write_run(root, SECOND)
    B.write_run(root, SKIP, "skipped_no_interface", with_capture=False)
    B.write_run(root, FAIL, "failed", with_capture=False)
    for run_id in SERIES.commissioning:
        B.write_run(root, run_id, None, with_capture=False)
    (root / "notes.txt").write_text("x")
    return root


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = build_tree(tmp_path_factory.mktemp("tree"))
    derived = str(tmp_path_factory.mktemp("derived"))
    outcomes = {r.run_id: (r.outcome, r.detail) for r in update(spark, str(root), derived, "b1", SERIES).collect()}
    views = build_views(spark, str(root), derived, NOW, SERIES)
    return root, derived, outcomes, views


def test_first_update_processes_every_attempt(built):
    assert built[2] == {r: ("processed", "no derivation manifest") for r in (SWEEP, SECOND, SKIP, FAIL)}


def test_core_tables_replay_source_rows(built):
    views = built[3]
    freq = views["pilot_frequencies"].where(F.col("run_id") == SWEEP).collect()
    assert len(freq) == 3
    assert [(r.sample_status, r.beacon_count) for r in freq if r.band == "6GHz"] == [("sampled_empty", 0)]
    obs = {r.bssid: r for r in views["pilot_observations"].where(F.col("run_id") == SWEEP).collect()}
    assert len(obs) == 4 and obs[B.AP2].ssid == '"Mesh' and obs[B.AP3].ssid == ""
    assert obs[B.AP3].beacon_interval_tu is None and obs[B.AP1].rssi_mean_dbm == -69.5


def test_health_names_every_hour(built):
    rows = {r.run_id: r for r in built[3]["pilot_run_health"].collect()}
    assert len(rows) == 7
    assert rows["20260827-170000"].state == C.MISSING_SLOT and rows["20260827-170000"].extraction_status is None
    assert rows[SKIP].state == C.SKIPPED and rows[SKIP].input_complete and rows[FAIL].state == C.FAILED
    assert {r for r in rows if rows[r].in_trend} == {SWEEP, SECOND}
    for run_id in SERIES.commissioning:
        assert rows[run_id].state == C.COMPLETED and not rows[run_id].eligible


def test_totals_keep_commissioning_apart(built):
    row = H.health_totals(built[3]["pilot_run_health"]).first()
    assert (row.completed_sweep, row.skipped_no_interface, row.failed, row.missing_hourly_slot) == (2, 1, 1, 1)
    assert (row.commissioning_reference, row.discovered_attempts, row.discovered_series_attempts) == (2, 6, 4)
    assert row.expected_slots == 5


def test_metric_views(built):
    views = built[3]
    hourly = {r.run_id: r for r in views["pilot_hourly_metrics"].collect()}
    assert set(hourly) == {SWEEP, SECOND}
    assert (hourly[SWEEP].observed_bssids, hourly[SWEEP].beacon_frames, hourly[SWEEP].manifest_frequencies) == (4, 5, 3)
    six = {r.run_id: r for r in views["pilot_6ghz_evidence"].collect()}[SWEEP]
    assert (six.direct_bssids, six.sampled_empty_frequencies, six.manifest_frequencies) == (0, 1, 1)
    assert (six.advertised_6ghz_neighbors, six.advertised_6ghz_disabled_links, six.ambiguous_rnr_rows) == (2, 1, 1)
    assert six.advertised_not_observed_nonconcurrent == 1
    caps = {r.run_id: r for r in views["pilot_capability_metrics"].collect()}[SWEEP]
    assert (caps.observed_bssids, caps.advertises_he, caps.carries_rnr) == (4, 1, 3)
    bands = {(r.run_id, r.band): r for r in views["pilot_band_metrics"].collect()}
    assert bands[(SWEEP, "6GHz")].observed_bssids == 0 and bands[(SWEEP, "6GHz")].attempted_frequencies == 1


def test_contract_columns_and_types(built):
    from quietband import schemas
    views = built[3]
    assert tuple(views) == C.VIEW_NAMES
    for name, table in (("pilot_runs", "run"), ("pilot_rnr", "rnr"), ("pilot_bss_load", "bss_load")):
        assert [(f.name, f.dataType) for f in views[name].schema] == [
            (f.name, f.dataType) for f in schemas.DERIVED[table]]


def test_briefing_numbers(spark, built):
    root, _, _, views = built
    rows = briefing(spark, str(root), "/derived", views, SERIES).collect()
    value = {(r.section, r.metric, r.run_id, r.label): r for r in rows}
    assert value[("Collection health", "completed_sweep", None, None)].numerator == 2
    assert value[("Commissioning reference", "observations", SERIES.commissioning[0], None)].numerator == 4
    he = value[("Capability advertisements", "advertises_he", None, None)]
    assert (he.numerator, he.denominator) == (2, 8)
    assert value[("Data-quality findings", "missing_slot", None, "20260827-170000")].numerator == 1
    assert value[("Data-quality findings", "ambiguous_rnr_rows", None, "2")].numerator == 2
    assert ("Scope and cutoff", "last_successful_sweep", None, SECOND) in value
    assert list(dict.fromkeys(r.section for r in rows)) == list(C.BRIEFING_SECTIONS)
    assert value[("Provenance", "derived_root", None, "/derived")] and ("Scope and cutoff", "series_start", None, SERIES.series_start) in value
    present = {r.run_id: r.numerator for r in rows if r.metric == "present"}
    assert present == dict.fromkeys(SERIES.commissioning, 1)


def test_an_absent_commissioning_run_has_a_row(spark):
    from quietband import schemas
    from quietband.operators.briefing import commissioning_summary

    none = spark.createDataFrame([], schemas.FREQUENCIES), spark.createDataFrame([], schemas.OBSERVATIONS)
    assert [tuple(r) for r in commissioning_summary(*none, ("20260827-054734",)).collect()] == [("20260827-054734", False, 0, 0, 0, 0)]


def test_unchanged_then_changed_then_stale(spark, built, tmp_path):
    root = build_tree(tmp_path / "tree")
    derived = str(tmp_path / "derived")
    enrich(spark, str(root), derived, "b1", SERIES)
    same = {r.run_id: r.outcome for r in plan_update(spark, str(root), derived, SERIES).collect()}
    assert set(same.values()) == {"unchanged"} and len(same) == 4

    table = root / SECOND / "aggregate.tsv"
    table.write_text(table.read_text().replace("\t2\t100\t", "\ttwo\t100\t"))
    B.write_run(root, "20260827-170003", "running")
    outcome = {r.run_id: (r.outcome, r.detail) for r in update(spark, str(root), derived, "b2", SERIES).collect()}
    assert outcome[SECOND] == ("processed", "source identity changed")
    assert outcome["20260827-170003"][0] == "deferred" and outcome[SWEEP][0] == "unchanged"

    # The bad cell fails the run: only its run row counts, and older batches are not read.
    views = build_views(spark, str(root), derived, NOW, SERIES)
    run = {r.run_id: r for r in views["pilot_runs"].collect()}
    assert run[SECOND].extraction_status == "failed" and "core tables" in run[SECOND].error
    caps = views["pilot_capability_metrics"].agg(F.sum("observed_bssids"), F.sum("advertises_he")).first()
    assert tuple(caps) == (4, 1)
    again = {r.run_id: r.detail for r in plan_update(spark, str(root), derived, SERIES).collect()}
    assert again[SECOND] == "prior derivation failed" and again[SWEEP] == "unchanged"


def test_a_lost_attempt_is_replaced(spark, tmp_path):
    root = tmp_path / "tree"
    B.write_run(root, SWEEP)
    clean, derived = str(tmp_path / "clean"), str(tmp_path / "derived")
    enrich(spark, str(root), clean, "b1", SERIES)
    # An attempt that wrote a table, with other days too, and died before its manifest.
    lost = D.read_stored(spark, clean, "observations").drop("batch", "run_date")
    D.write_derived(lost.unionByName(lost.withColumn("run_id", F.lit("20260701-000000"))), derived, "observations", "b1")
    enrich(spark, str(root), derived, "b1", SERIES)
    digests = [sorted(map(tuple, D.batch_digests(spark, r, "b1").collect())) for r in (clean, derived)]
    assert digests[0] == digests[1]
    with pytest.raises(ValueError, match="recorded already"):
        enrich(spark, str(root), derived, "b1", SERIES)


def test_damage_and_gaps_are_errors(spark, tmp_path):
    root = tmp_path / "tree"
    B.write_run(root, SWEEP)
    derived = str(tmp_path / "derived")
    enrich(spark, str(root), derived, "b1", SERIES)
    # A part file that the manifest does not know.
    extra = D.read_stored(spark, derived, "observations").limit(1)
    extra.write.mode("append").partitionBy("batch", "run_date").parquet(f"{derived}/observations")
    with pytest.raises(I.ReconciliationError, match="observations"):
        build_views(spark, str(root), derived, NOW, SERIES)
    detail = plan_update(spark, str(root), derived, SERIES).first().detail
    assert detail == "derived outputs no longer match the manifest"
    B.write_run(root, SECOND)
    with pytest.raises(I.ReconciliationError, match=SECOND):
        build_views(spark, str(root), derived, NOW, SERIES)
    assert [r.run_id for r in spark.read.parquet(f"{derived}/reports/unreconciled").collect()] == [SECOND]
    assert [r.name for r in spark.read.parquet(f"{derived}/reports/damaged").collect()] == ["observations.parquet"]


def test_unreadable_capture_makes_its_run_partial(spark, tmp_path):
    root = tmp_path / "tree"
    B.write_run(root, SWEEP)
    (root / SWEEP / "freq-2412.pcap").write_bytes(B.sample_capture()[:-3])
    B.write_run(root, SECOND)
    derived = str(tmp_path / "derived")
    enrich(spark, str(root), derived, "b1", SERIES)
    views = build_views(spark, str(root), derived, NOW, SERIES)
    status = {r.run_id: r.extraction_status for r in views["pilot_runs"].collect()}
    assert status == {SWEEP: "partial", SECOND: "succeeded"}
    assert views["pilot_observations"].count() == 8
    assert {r.run_id for r in views["pilot_rnr"].select("run_id").distinct().collect()} == {SECOND}


def test_a_blank_table_is_not_called_missing(spark, tmp_path):
    from quietband.operators.enrichment import core_errors

    for run_id in (SWEEP, SECOND):
        B.write_run(tmp_path, run_id)
    (tmp_path / SWEEP / "frequencies.tsv").write_text("\nx\n")
    (tmp_path / SECOND / "aggregate.tsv").unlink()
    none = spark.createDataFrame([], "run_id string, bad_cell boolean")
    errors = {r.run_id: r.error for r in core_errors(tree.registry(spark, str(tmp_path)), none, none).collect()}
    assert errors == {SWEEP: "no header in source file: frequencies.tsv", SECOND: "missing source file: aggregate.tsv"}


def test_files_are_hashed_once_and_trusted_only_when_asked(spark, tmp_path, monkeypatch):
    """Large files are hashed in blocks; a known hash is taken over for the same size and time."""
    import hashlib
    import os

    from quietband.sources import run_tree as R

    B.write_run(tmp_path, SWEEP)
    files = R.list_sources(R.list_children(spark, str(tmp_path)))
    found = {r.name: r for r in R.file_identity(files).collect()}
    assert set(found) == {"instrument.json", "frequencies.tsv", "aggregate.tsv", "freq-2412.pcap", "freq-2437.pcap", "freq-5955.pcap"}
    for name, r in found.items():
        assert r.sha256 == hashlib.sha256((tmp_path / SWEEP / name).read_bytes()).hexdigest()
    known = spark.createDataFrame([(SWEEP, r.name, r.size, r.modified, "known") for r in found.values()],
                                  "run_id string, name string, size bigint, modified bigint, sha256 string")
    table = tmp_path / SWEEP / "aggregate.tsv"
    table.write_text(table.read_text().replace("TestNet", "NetTest"))
    os.utime(table, ns=(0, found["aggregate.tsv"].modified + 1))
    trusted = {r.name: r.sha256 for r in R.file_identity(files, known).collect()}
    assert trusted.pop("aggregate.tsv") == hashlib.sha256(table.read_bytes()).hexdigest() and set(trusted.values()) == {"known"}
    table.unlink()
    assert R.hash_files(spark.createDataFrame([(SWEEP, "gone.tsv", str(table), 1, 1)], files.schema)).first().sha256 is None
    assert R.list_children(spark, str(tmp_path / "absent")).count() == 0


def test_stored_rows_are_read_once(spark, built, monkeypatch):
    """Digests of known part files are kept; only `reread` looks at them again."""
    root, derived, _, _ = built
    read = []
    monkeypatch.setattr(D, "read_stored", lambda s, r, table, real=D.read_stored: read.append(table) or real(s, r, table))
    before = sorted(map(tuple, D.stored_digests(spark, derived).collect()))
    assert read == [] and before
    assert sorted(map(tuple, D.stored_digests(spark, derived, reread=True).collect())) == before and len(read) == 7
    assert {r.name for r in D.batch_digests(spark, derived, "b1").collect()} == {f"{t}.parquet" for t in C.DERIVED_TABLES}


def test_an_update_that_trusts_unchanged_files(spark, built, tmp_path):
    root = build_tree(tmp_path / "tree")
    derived = str(tmp_path / "derived")
    update(spark, str(root), derived, "b1", SERIES)
    table = root / SECOND / "aggregate.tsv"
    table.write_text(table.read_text() + "\n")
    for trust in (True, False):
        outcome = {r.run_id: r.outcome for r in update(spark, str(root), derived, f"b{2 + trust}", SERIES, trust_unchanged=trust).collect()}
        assert outcome == {SWEEP: "unchanged", SKIP: "unchanged", FAIL: "unchanged", SECOND: "processed" if trust else "unchanged"}


def test_empty_tree_gives_twelve_typed_views(spark, tmp_path):
    root = tmp_path / "tree"
    root.mkdir()
    views = build_views(spark, str(root), str(tmp_path / "none"), datetime(2026, 8, 27, 8), SERIES)
    assert [views[n].count() for n in C.VIEW_NAMES] == [0] * 12


def test_states_of_odd_runs(spark, tmp_path):
    root = tmp_path
    B.write_run(root, "20260827-130003", "paused")
    B.write_run(root, "20260827-140003", None)
    B.write_run(root, "20260827-150003", document="{not json")
    B.write_run(root, "20260827-160003", "sweep", tables=False)
    B.write_run(root, "20260827-170003", "skipped_no_interface", tables=False)
    B.write_run(root, "20260827-080003")
    B.write_run(root, "20261327-080003")
    (root / "not-a-run").mkdir()
    (root / "20260827-180003").write_text("a file")
    (root / "20260827-190003").mkdir()
    B.write_run(root, "20260827-200003", document="[1]")
    rows = {r.run_id: r for r in tree.classified(spark, str(root), SERIES).collect()}
    state = {k: (r.membership, r.attempt_state) for k, r in rows.items()}
    assert state["20260827-130003"] == (C.PILOT, C.MALFORMED)
    assert rows["20260827-130003"].reason == "unknown run_status 'paused'"
    for run_id in ("14", "15", "16", "19", "20"):
        assert state[f"20260827-{run_id}0003"] == (C.PILOT, C.MALFORMED), run_id
    assert state["20260827-170003"] == (C.PILOT, C.SKIPPED) and not rows["20260827-170003"].input_complete
    assert state["20260827-080003"] == (C.OUTSIDE, None) and state["not-a-run"] == (C.OUTSIDE, None)
    assert rows["20260827-180003"].reason == "not a directory"
    assert rows["20261327-080003"].reason == "run id is not a real time"


@pytest.mark.parametrize("now, first, last, n", [
    (datetime(2026, 8, 27, 14, 30), "20260827-090000", "20260827-140000", 6),
    (datetime(2026, 8, 27, 8), None, None, 0),
])
def test_expected_slots(spark, now, first, last, n):
    slots = sorted(r.slot for r in H.expected_slots(H.clock(spark, now), SeriesConfig("20260827-090003", ("20260827-054734", "20260827-060013"))).collect())
    assert len(slots) == n and (not n or (slots[0], slots[-1]) == (first, last))


def test_slots_do_not_follow_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:00 does not exist in New York on this date.
        series = SeriesConfig("20260308-010003", ())
        slots = sorted(r.slot for r in H.expected_slots(H.clock(spark, datetime(2026, 3, 8, 3, 30)), series).collect())
        assert slots == ["20260308-010000", "20260308-020000", "20260308-030000"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_medians_by_narrowing(spark):
    """Ten million distinct values over the whole range of 64 bits, few and negative ones, ties, nulls."""
    from pyspark.sql import functions as F

    from quietband.operators.briefing import _medians

    wide = spark.range(10_000_000).select(F.lit("wide").alias("measure"), (F.col("id") * 900_000_000_001).alias("v"))
    small = [("odd", 3), ("odd", -5), ("odd", 2**62), ("pair", 7), ("pair", 8), ("pair", None), ("pair", -(2**50)), ("pair", 2**50),
             ("ties", 4), ("ties", 4), ("ties", 4), ("ties", 9), ("one", 6), ("apart", 0), ("apart", 2**45)]
    rows = wide.unionByName(spark.createDataFrame(small, "measure string, v long"))
    got = {r.measure: r.median for r in _medians(rows).collect()}
    assert got.pop("wide") == (4_999_999 + 5_000_000) * 900_000_000_001 / 2
    assert got == {"odd": 3.0, "pair": 7.5, "ties": 4.0, "one": 6.0, "apart": 2.0**44}
    assert _medians(rows.where("false")).isEmpty()

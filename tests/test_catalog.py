"""Every query against its oracle on the smallest tables, and what no plan may contain."""

import os

import pytest

from verification.catalog import ORACLES, QUERIES
from verification.compare import differences, open_duckdb
from verification.inputs import Inputs

SF = "/root/testdata/sf0.001"
# These write one folder per run hour; the two kept here cover both kinds of writer.
RUN_FOLDERS = {"a2_observation_scan", "a3_sweep_load", "a6_header_probe", "a9_manifest_scan", "b6_summary_tsv"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroups")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are absent")


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SF)


@pytest.fixture(scope="module")
def con():
    return open_duckdb(SF)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys() and len(QUERIES) > 160


@pytest.mark.parametrize("key", [k for k in QUERIES if k not in RUN_FOLDERS])
def test_query(key, inputs, con):
    df = QUERIES[key](inputs)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]
    assert ("MapInArrow" in plan) == (key == "a7_capture_decode")
    assert differences(df, con, ORACLES[key]) is None


def test_a_view_asks_for_its_own_tables_only(spark):
    """Evidence needs three facts; the other derived tables are not made for it."""
    made = Inputs(spark, SF)
    made.views["pilot_6ghz_evidence"]
    assert made._derived.keys() == {"rnr"}


def test_events_are_dealt_and_frames_stay_in_place(spark):
    """One small file becomes many tasks' work, and a few bad runs are taken out without a shuffle of the frames."""
    made = Inputs(spark, SF)
    assert len(made.ev.inputFiles()) > 1
    plan = made.identified.select("run_id", "tags")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_events_are_dealt_before_they_are_mapped(spark, monkeypatch):
    """The mapping of a small file is not the work of one task; wide steps are generated in methods that the JVM compiles."""
    plans = []
    monkeypatch.setattr(Inputs, "stored", lambda self, label, rows: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or rows)
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    Inputs(spark, SF).ev
    assert plans[0].startswith("Project") and plans[0].index("get_json_object") < plans[0].index("Repartition")
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_capabilities_make_no_arrays_of_an_address(spark):
    """Words of bits become text and flags by lookups; no loop over 64 bits runs for every address."""
    from quietband.operators import enrichment as E

    plan = E.ie_capabilities(Inputs(spark, SF).frames)._jdf.queryExecution().optimizedPlan().toString()
    after = plan[: plan.index("Aggregate")]
    assert "lambda" not in after and "arrays_overlap" not in after

"""Incremental update: what must be derived again and why, and deriving it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietband.config import SeriesConfig
from quietband.operators import incremental as I
from quietband.operators.membership import inventory
from quietband.plans import tree
from quietband.plans.enrich import enrich
from quietband.sources import derived as D
from quietband.sources.run_tree import file_identity, list_sources


def plan_update(
    spark: SparkSession, root: str, derived_root: str, series: SeriesConfig, registry: DataFrame | None = None,
    identity: DataFrame | None = None,
) -> DataFrame:
    """Outcome and reason of every eligible attempt; `identity` are the hashes of the tree's files, by default read here."""
    registry = tree.registry(spark, root) if registry is None else registry
    classified = inventory(registry, series)
    manifests = D.read_manifest_table(spark, derived_root)
    recorded, roots = D.recorded_identity(spark, derived_root, manifests)
    identity = file_identity(list_sources(registry)) if identity is None else identity
    changed = I.changed_runs(recorded, identity, roots)
    damaged = I.damaged_outputs(
        I.recorded_outputs(manifests), D.recorded_batch_digests(spark, derived_root, manifests)
    )
    eligible = classified.where("eligible")
    decisions = I.reprocess_decisions(eligible, manifests, changed, damaged, series)
    return I.update_outcomes(classified, decisions)


def update(
    spark: SparkSession, root: str, derived_root: str, batch: str, series: SeriesConfig, trust_unchanged: bool = False
) -> DataFrame:
    """Derive what changed as one batch; returns the outcomes the decision was made on.

    Every source file is hashed once, whatever follows, and what is derived is read once more to be decoded. With
    `trust_unchanged` a file whose size and time of change are as recorded keeps its recorded hash and is not opened: an
    update then reads nothing of what did not change, and misses a change that keeps both.
    """
    registry = tree.stored_registry(spark, root, derived_root, batch)
    files = tree.stored_files(registry, derived_root, batch)
    known = D.recorded_identity(spark, derived_root, D.read_manifest_table(spark, derived_root))[0] if trust_unchanged else None
    identity_path = f"{derived_root}/listing/batch={batch}-identity"
    file_identity(files, known).write.mode("overwrite").parquet(identity_path)
    identity = spark.read.parquet(identity_path)
    # The decision is stored first: deriving changes the very tables it was read from.
    outcomes_path = f"{derived_root}/outcomes/batch={batch}"
    planned = plan_update(spark, root, derived_root, series, registry, identity)
    planned.write.mode("overwrite").parquet(outcomes_path)
    outcomes = spark.read.schema(planned.schema).parquet(outcomes_path)
    todo = outcomes.where(F.col("outcome") == "processed").select("run_id")
    if not todo.isEmpty():
        enrich(spark, root, derived_root, batch, series, todo, registry, files, identity)
    for left in (f"{derived_root}/listing/batch={batch}", identity_path, f"{derived_root}/registry/batch={batch}"):
        D.remove(spark, left)
    return outcomes

"""Change detection, output integrity and reconciliation of derived runs.

Derived tables are append-only: a derivation writes a new ``batch`` and the manifest, which
is written last, names the batch that counts.  A job that dies half-way leaves a batch no
manifest mentions, so readers never see it and a retry needs no clean-up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietband import config as C
from quietband.config import SeriesConfig


class ReconciliationError(RuntimeError):
    """Derived tables, manifests and the run tree disagree."""


def recorded_sources(manifests: DataFrame) -> DataFrame:
    return manifests.select("run_id", F.inline("source_files"))


def recorded_outputs(manifests: DataFrame) -> DataFrame:
    return manifests.select("run_id", F.inline("outputs"))


def run_roots(files: DataFrame) -> DataFrame:
    """(run_id, day, root): one hash over the names, sizes and hashes of a run's files. A run has a few hundred at most."""
    line = F.concat_ws("\n", "name", F.col("size").cast("string"), F.coalesce("sha256", F.lit("unread")))
    return files.groupBy("run_id").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("root")).select(
        "run_id", F.substring("run_id", 1, 8).alias("day"), "root"
    )


def day_roots(runs: DataFrame) -> DataFrame:
    """(day, root): one hash over a day's runs. A day has some twenty-four."""
    line = F.concat_ws("\n", "run_id", "root")
    return runs.groupBy("day").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("root"))


def _unlike(was: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """Keys whose roots differ, or that only one side has."""
    both = was.select(key, F.col("root").alias("was")).join(now.select(key, F.col("root").alias("now")), key, "full_outer")
    return both.where(~F.col("was").eqNullSafe(F.col("now"))).select(key)


def changed_files(recorded: DataFrame, current: DataFrame, recorded_roots: DataFrame | None = None) -> DataFrame:
    """Every (run, file) that was added, removed or altered since it was recorded.

    Files, runs and days form a hash tree. A day with the same root on both sides is ruled out as a whole, and so is a run of
    a day that differs; files are compared for what is left. `recorded_roots` are the run roots as stored with the record.
    """
    was_runs = run_roots(recorded) if recorded_roots is None else recorded_roots
    now_runs = run_roots(current)
    days = _unlike(day_roots(was_runs), day_roots(now_runs), "day")
    runs = _unlike(was_runs.join(days, "day", "left_semi"), now_runs.join(days, "day", "left_semi"), "run_id")

    def left(files: DataFrame, name: str) -> DataFrame:
        return files.join(runs, "run_id", "left_semi").select("run_id", "name", F.struct("sha256", "size").alias(name))

    change = (
        F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed")
        # A file that could not be read is altered.
        .when(~F.coalesce(F.col("was") == F.col("now"), F.lit(False)) | F.col("now.sha256").isNull(), "altered")
    )
    return (
        left(recorded, "was").join(left(current, "now"), ["run_id", "name"], "full_outer")
        .select("run_id", "name", change.alias("change")).where(F.col("change").isNotNull())
    )


def changed_runs(recorded: DataFrame, current: DataFrame, recorded_roots: DataFrame | None = None) -> DataFrame:
    return changed_files(recorded, current, recorded_roots).groupBy("run_id").agg(F.count("*").alias("changed_files"))


def row_digests(rows: DataFrame, *keys: str | Column) -> DataFrame:
    """(keys, rows, total, mixed): row count, and sum and xor of row hashes. They add up over any split of the rows.

    Sums and xors combine map-side, so a run holding most rows costs no more than others.
    """
    columns = sorted(c for c in rows.columns if c not in ("batch", "run_date"))
    digest = F.xxhash64(*columns)
    return rows.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.sum(digest.cast("decimal(38,0)")).alias("total"), F.bit_xor(digest).alias("mixed")
    )


def added_up(parts: DataFrame, *keys: str) -> DataFrame:
    """(keys, rows, sha256) from the digests of parts: the content digest as manifests record it."""
    return parts.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.concat_ws(":", F.sum("total").cast("decimal(38,0)").cast("string"), F.bit_xor("mixed").cast("string")).alias("sha256"),
    )


def table_digest(rows: DataFrame, table: str) -> DataFrame:
    """Row count and order-free content digest of each run's share of a table."""
    return added_up(row_digests(rows, "run_id"), "run_id").select("run_id", F.lit(f"{table}.parquet").alias("name"), "rows", "sha256")


def damaged_outputs(recorded: DataFrame, actual: DataFrame) -> DataFrame:
    """Recorded outputs whose rows are missing, altered or miscounted.

    An output recorded as empty has no digest row to find and is intact while it stays so.
    """
    found = actual.select("run_id", "name", F.struct("rows", "sha256").alias("found"))
    problem = (
        F.when((F.col("rows") == 0) & F.col("found").isNull(), None)
        .when(F.col("found").isNull(), "missing output")
        .when(~F.col("found.sha256").eqNullSafe(F.col("sha256")), "content differs from the manifest")
        .when(F.col("found.rows") != F.col("rows"), "row count differs from the manifest")
    )
    return (
        recorded.join(found, ["run_id", "name"], "left")
        .select("run_id", "name", problem.alias("problem")).where(F.col("problem").isNotNull())
    )


def reprocess_decisions(
    runs: DataFrame, manifests: DataFrame, changed: DataFrame, damaged: DataFrame, series: SeriesConfig
) -> DataFrame:
    """(run_id, needed, reason): the first rule that holds decides.

    An unchanged ``partial`` derivation is done, not retried.
    """
    known = manifests.select(
        "run_id", F.lit(True).alias("known"), "status", "schema_id", "extractor_version"
    )
    joined = (
        runs.select("run_id").join(known, "run_id", "left")
        .join(changed.select("run_id", F.lit(True).alias("changed")), "run_id", "left")
        .join(damaged.select("run_id", F.lit(True).alias("damaged")).distinct(), "run_id", "left")
    )
    differs = lambda c, v: ~F.col(c).eqNullSafe(F.lit(v))
    reason = (
        F.when(F.col("known").isNull(), C.REASONS["no_manifest"])
        .when(~F.coalesce(F.col("status").isin("succeeded", "partial"), F.lit(False)),
              C.REASONS["failed_before"])
        .when(differs("schema_id", series.derived_schema_id), C.REASONS["schema_changed"])
        .when(differs("extractor_version", series.extractor_version), C.REASONS["extractor_changed"])
        .when(F.col("changed"), C.REASONS["source_changed"])
        .when(F.col("damaged"), C.REASONS["outputs_changed"])
        .otherwise("unchanged")
    )
    return joined.select("run_id", reason.alias("reason")).withColumn(
        "needed", F.col("reason") != "unchanged"
    )


def update_outcomes(classified: DataFrame, decisions: DataFrame) -> DataFrame:
    """Outcome and reason of every eligible attempt; none is silently absent."""
    joined = classified.where("eligible").select("run_id", "attempt_state").join(decisions, "run_id", "left")
    running = F.col("attempt_state") == C.RUNNING
    return joined.select(
        "run_id", "attempt_state",
        F.when(running, "deferred").when(F.col("needed"), "processed").otherwise("unchanged").alias("outcome"),
        F.when(running, C.REASONS["deferred"]).otherwise(F.col("reason")).alias("detail"),
    )


def unreconciled_runs(classified: DataFrame, manifests: DataFrame) -> DataFrame:
    """Eligible attempts that are neither derived nor still running."""
    waiting = classified.where(F.col("eligible") & (F.col("attempt_state") != C.RUNNING))
    return waiting.select("run_id").join(manifests.select("run_id"), "run_id", "left_anti")


def _report(rows: DataFrame, path: str, what: str, line) -> None:
    """Raise when there are rows: all are written to `path`, a few are named."""
    if rows.isEmpty():
        return
    rows.write.mode("overwrite").parquet(path)
    written = rows.sparkSession.read.schema(rows.schema).parquet(path)
    named = [line(r) for r in written.orderBy(*written.columns).limit(20).collect()]
    raise ReconciliationError(f"{what}, all {written.count()} in {path}, first: {named}")


def require_reconciled(classified: DataFrame, manifests: DataFrame, report: str) -> None:
    """Raise when eligible attempts have no manifest; they are listed in the table at `report`."""
    _report(
        unreconciled_runs(classified, manifests), report, "eligible attempts without a derivation manifest",
        lambda r: r.run_id,
    )


def require_intact(damaged: DataFrame, report: str) -> None:
    """Raise when any recorded output no longer matches its manifest; they are listed in the table at `report`."""
    _report(damaged, report, "damaged outputs", lambda r: f"{r.run_id}: {r.name} {r.problem}")


def latest_manifests(manifests: DataFrame) -> DataFrame:
    """The newest manifest of each run."""
    columns = [c for c in manifests.columns if c != "run_id"]
    return manifests.groupBy("run_id").agg(
        F.max_by(F.struct(*columns), F.col("derived_version")).alias("m")
    ).select("run_id", "m.*")


def _admits(table: str):
    """Whether a manifest status lets a table's rows count.

    ``succeeded`` admits every table, ``partial`` the core ones, ``failed`` the run row only.
    """
    if table == "run":
        return F.lit(True)
    allowed = ("succeeded",) if table in C.ADVANCED_TABLES else ("succeeded", "partial")
    return F.coalesce(F.col("status").isin(*allowed), F.lit(False))


def gated(rows: DataFrame, manifests: DataFrame, table: str) -> DataFrame:
    """Rows of runs whose extraction status lets this table count."""
    return rows.join(manifests.where(_admits(table)).select("run_id"), "run_id", "left_semi")


def gated_batches(rows: DataFrame, history: DataFrame, table: str) -> DataFrame:
    """Stored rows that count, given every manifest ever written.

    Rows are excluded rather than admitted: the (run, batch) pairs to drop - re-derived, or of
    a status that does not admit the table - are few in a healthy series, while the admitted
    ones grow with it.  Batches without any manifest belong to jobs that never finished; that
    check is on the partition column and prunes whole folders.
    """
    keys = history.select("run_id", "status", F.col("derived_version").alias("batch"))
    newest = keys.groupBy("run_id").agg(F.max("batch").alias("newest"))
    dropped = (
        keys.join(newest, "run_id")
        .where((F.col("batch") != F.col("newest")) | ~_admits(table))
        .select("run_id", "batch")
    )
    finished = keys.select("batch").distinct()
    return rows.join(finished, "batch", "left_semi").join(dropped, ["run_id", "batch"], "left_anti")

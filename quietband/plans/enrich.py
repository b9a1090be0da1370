"""Run tree to the seven derived tables and their manifests."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietband import config as C
from quietband import schemas
from quietband.config import SeriesConfig
from quietband.operators import enrichment as E
from quietband.operators.membership import inventory
from quietband.plans import tree
from quietband.session import run_together
from quietband.sources import derived as D
from quietband.sources.captures import decode_captures
from quietband.sources.run_tree import file_identity


def derive_tables(
    classified: DataFrame, registry: DataFrame, frequencies: DataFrame, observations: DataFrame,
    frames: DataFrame, series: SeriesConfig, errors: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The seven tables of the runs in `classified`, from text tables, decoded frames and their identity errors."""
    runs = classified.select("run_id")
    errors = E.identity_errors(frames) if errors is None else errors
    status = E.extraction_status(runs, E.core_errors(registry, frequencies, observations), errors)
    good = E.identified_frames(frames, errors)
    return {
        "run": E.run_table(classified, status, series),
        "frequencies": schemas.conform(frequencies, schemas.FREQUENCIES),
        "observations": schemas.conform(observations, schemas.OBSERVATIONS),
        "ie_capabilities": E.ie_capabilities(good),
        "rnr": E.rnr_records(good),
        "bss_load": E.bss_load_records(good),
        "field_resolution": E.resolve_fields(runs, E.decoder_fields(runs)),
    }


def enrich(
    spark: SparkSession, root: str, derived_root: str, batch: str, series: SeriesConfig,
    runs: DataFrame | None = None, registry: DataFrame | None = None, files: DataFrame | None = None,
    identity: DataFrame | None = None,
) -> None:
    """Derive `runs` (default: every eligible finished attempt) as one batch.

    `files` is the tree's listing and `identity` what is known of their hashes; both are made here where they are not given.
    Frames are decoded once into a stored table, so a lost executor re-reads files instead of re-decoding. Captures are chosen by
    joining their listing, which holds no bytes. The manifest is written last; until then a batch can be run again and
    replaces what an earlier attempt left. A batch with a manifest is refused.
    """
    if not D.read_manifest_history(spark, derived_root).where(F.col("derived_version") == batch).isEmpty():
        raise ValueError(f"batch {batch} is recorded already")
    registry = tree.stored_registry(spark, root, derived_root, batch) if registry is None else registry
    classified = inventory(registry, series).where(
        F.col("eligible") & (F.col("attempt_state") != C.RUNNING)
    )

    def chosen(rows: DataFrame) -> DataFrame:
        wanted = runs if runs is not None else classified.select("run_id")
        return rows.join(wanted, "run_id", "left_semi")

    files = tree.stored_files(registry, derived_root, batch) if files is None else files
    frames_path = f"{derived_root}/frames/batch={batch}"
    run_together([
        lambda: decode_captures(tree.captures(chosen(files))).write.mode("overwrite").parquet(frames_path),
        lambda: D.write_sources(file_identity(chosen(files)) if identity is None else chosen(identity), derived_root, batch),
    ])
    frames = spark.read.schema(schemas.FRAMES).parquet(frames_path)
    found, errors_path = E.identity_errors(frames), f"{derived_root}/frames/errors={batch}"
    found.write.mode("overwrite").parquet(errors_path)
    errors = spark.read.schema(found.schema).parquet(errors_path)

    tables = derive_tables(
        chosen(classified), registry, chosen(tree.frequencies(spark, root)),
        chosen(tree.observations(spark, root)), frames, series, errors,
    )
    run_together([partial(D.write_derived, tables[name], derived_root, name, batch) for name in C.DERIVED_TABLES])

    run = D.read_stored(spark, derived_root, "run").where(F.col("batch") == batch)
    sources = spark.read.parquet(f"{derived_root}/sources/batch={batch}")
    D.write_manifests(
        D.build_manifests(run, sources, D.batch_digests(spark, derived_root, batch), batch), derived_root, batch
    )
    # What the batch was made from is in the tree.
    D.remove(spark, frames_path)
    D.remove(spark, errors_path)
    D.remove(spark, f"{derived_root}/listing/batch={batch}")

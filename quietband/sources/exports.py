"""Text and parquet exports, and the published views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietband import config as C
from quietband.sources.survey_files import AGGREGATE_COLUMNS, FREQUENCY_COLUMNS


def write_tsv(rows: DataFrame, path: str, by_run: bool = False) -> None:
    """Tab-separated text with a header, no quoting and no escapes.

    Cells must not hold tabs or line breaks; names are made single-line when decoded.
    """
    text = rows.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns]
    )
    writer = text.write.mode("overwrite").options(
        sep="\t", header=True, quote="", escape="", emptyValue="", nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    if by_run:
        writer = writer.partitionBy("run_id")
    writer.csv(path)


def write_summary_tables(frequencies: DataFrame, summary: DataFrame, root: str) -> None:
    """Manifest and aggregate text tables, one folder per run.

    Rebalancing gathers each run's rows and still splits a run that holds most of them.
    """
    write_tsv(frequencies.select("run_id", *FREQUENCY_COLUMNS).hint("rebalance", "run_id"),
              f"{root}/frequencies", by_run=True)
    write_tsv(summary.select("run_id", *AGGREGATE_COLUMNS).hint("rebalance", "run_id"),
              f"{root}/aggregate", by_run=True)


def write_census_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Census exports: ``ie-census``, ``rnr`` and ``bss-load``."""
    for name, rows in tables.items():
        write_tsv(rows, f"{root}/{name}.tsv")


def sweep_export(rows: DataFrame) -> DataFrame:
    """Rows keyed by ``sweep_id`` as first column."""
    rest = [c for c in rows.columns if c != "run_id"]
    return rows.select(F.col("run_id").alias("sweep_id"), *rest)


def write_sweep_parquet(observations: DataFrame, frequencies: DataFrame, root: str) -> None:
    sweep_export(observations).write.mode("overwrite").parquet(f"{root}/observations.parquet")
    sweep_export(frequencies).write.mode("overwrite").parquet(f"{root}/frequencies.parquet")


def publish_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    """Register the twelve views; a missing one is an error, not a shorter list."""
    for name, rows in views.items():
        rows.createOrReplaceTempView(name)
    missing = [n for n in C.VIEW_NAMES if n not in views or not spark.catalog.tableExists(n)]
    if missing:
        raise RuntimeError(f"required views missing after build: {missing}")

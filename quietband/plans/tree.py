"""A run tree on storage as the relations the jobs start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietband import schemas
from quietband.config import SeriesConfig
from quietband.operators.membership import inventory
from quietband.sources import run_tree as R
from quietband.sources import survey_files as S


def registry(spark: SparkSession, root: str) -> DataFrame:
    """Children of the tree with their instrument and text-table evidence."""
    if S.matches(spark, f"{root}/*/instrument.json"):
        instruments = S.read_instruments(spark, f"{root}/*/instrument.json")
    else:
        instruments = S.parse_instruments(spark.createDataFrame([], "run_id string, document string"))
    tables = f"{root}/*/{{frequencies,aggregate}}.tsv"
    if S.matches(spark, tables):
        headers = S.read_text_headers(spark, tables)
    else:
        headers = spark.createDataFrame([], "run_id string, file string, readable boolean")
    return S.assemble_registry(R.list_children(spark, root), instruments, headers)


def _snapshot(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def stored_registry(spark: SparkSession, root: str, derived_root: str, label: str) -> DataFrame:
    """The registry as one stored snapshot, so every step of a job sees the same tree."""
    return _snapshot(registry(spark, root), f"{derived_root}/registry/batch={label}")


def stored_files(registry: DataFrame, derived_root: str, label: str) -> DataFrame:
    """The parsed files of the registry's runs as one stored listing."""
    return _snapshot(R.list_sources(registry), f"{derived_root}/listing/batch={label}")


def classified(spark: SparkSession, root: str, series: SeriesConfig) -> DataFrame:
    return inventory(registry(spark, root), series)


def _typed_empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema).withColumn("bad_cell", F.lit(False))


def frequencies(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/*/frequencies.tsv"
    return S.read_frequencies(spark, path) if S.matches(spark, path) else _typed_empty(spark, schemas.FREQUENCIES)


def observations(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/*/aggregate.tsv"
    return S.read_observations(spark, path) if S.matches(spark, path) else _typed_empty(spark, schemas.OBSERVATIONS)


def captures(files: DataFrame) -> DataFrame:
    """(run_id, pcap_file, length, path) of the captures among listed files."""
    return files.where(F.col("name").endswith(".pcap")).select(
        "run_id", F.col("name").alias("pcap_file"), F.col("size").alias("length"), "path"
    )

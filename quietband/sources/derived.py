"""Derived tables on shared storage: append a batch, record it, read what is recorded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quietband import config as C
from quietband import schemas
from quietband.operators import incremental as I


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + schemas.STORED_COLUMNS.fields)


def write_derived(rows: DataFrame, root: str, table: str, batch: str) -> None:
    """Write one batch of a table in contract column order, in place of what an earlier attempt left.

    Partitions are days, not runs, so a year is a few hundred folders.
    """
    remove(rows.sparkSession, f"{root}/{table}/batch={batch}")
    (
        schemas.conform(rows, schemas.DERIVED[table])
        .withColumns({"batch": F.lit(batch), "run_date": F.substring("run_id", 1, 8)})
        .hint("rebalance", "run_date")
        .write.mode("append").partitionBy("batch", "run_date").parquet(f"{root}/{table}")
    )


def remove(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def read_stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All stored batches of a table; a table never written is empty but typed."""
    schema = _stored(schemas.DERIVED[table])
    path = f"{root}/{table}"
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def read_manifest_history(spark: SparkSession, root: str) -> DataFrame:
    """Every manifest ever written; none at all is an empty relation."""
    path = f"{root}/manifests"
    if not _exists(spark, path):
        return spark.createDataFrame([], schemas.MANIFEST)
    return spark.read.schema(schemas.MANIFEST).option("recursiveFileLookup", "true").json(path)


def read_manifest_table(spark: SparkSession, root: str) -> DataFrame:
    """The newest manifest of each run."""
    return I.latest_manifests(read_manifest_history(spark, root))


def read_derived(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The seven tables as the manifests admit them."""
    history = read_manifest_history(spark, root)
    return {
        table: I.gated_batches(read_stored(spark, root, table), history, table).select(
            *schemas.DERIVED[table].fieldNames()
        )
        for table in C.DERIVED_TABLES
    }


_PART = "table string, file string, size bigint, modified timestamp"
_PART_DIGESTS = f"{_PART}, batch string, run_id string, rows bigint, total decimal(38,0), mixed bigint"


def part_files(spark: SparkSession, root: str) -> DataFrame:
    """(table, file, size, modified, batch) of all stored part files: a listing, no file is opened."""
    parts = [
        spark.read.format("binaryFile").options(pathGlobFilter="*.parquet", recursiveFileLookup=True).load(f"{root}/{table}").select(
            F.lit(table).alias("table"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("modified"),
            F.regexp_extract(F.col("_metadata.file_path"), "/batch=([^/]+)/", 1).alias("batch"),
        )
        for table in C.DERIVED_TABLES if _exists(spark, f"{root}/{table}")
    ]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], f"{_PART}, batch string")


def stored_digests(spark: SparkSession, root: str, reread: bool = False) -> DataFrame:
    """(run_id, batch, name, rows, sha256): row counts and content digests of what is stored.

    Digests add up over part files, and those of files met before are kept beside the tables, by name, size and time of change.
    Only files without one are read, and of partitioned tables only batches that hold such a file. `reread` reads all, which also
    finds a file whose bytes changed while its size and time did not.
    """
    known_path = f"{root}/verified"
    present = part_files(spark, root)
    same = ["table", "file", "size", "modified"]
    if reread or not _exists(spark, known_path):
        known = spark.createDataFrame([], _PART_DIGESTS)
    else:
        known = spark.read.schema(_PART_DIGESTS).parquet(known_path)
    fresh = present.join(known, same, "left_anti")
    # One row per table and batch that is not verified yet.
    wanted: dict[str, list[str]] = {}
    for r in fresh.select("table", "batch").distinct().collect():
        wanted.setdefault(r.table, []).append(r.batch)
    parts = []
    for table, batches in wanted.items():
        rows = read_stored(spark, root, table).where(F.col("batch").isin(batches))
        keys = {"file": "file_path", "size": "file_size", "modified": "file_modification_time"}
        digests = I.row_digests(rows, *[F.col(f"_metadata.{m}").alias(k) for k, m in keys.items()], "batch", "run_id")
        parts.append(digests.select(F.lit(table).alias("table"), *keys, "batch", "run_id", "rows", "total", "mixed"))
    if parts:
        new = reduce(DataFrame.unionByName, parts)
        # A batch can hold files that are known already.
        new.join(fresh.select(*same), same, "left_semi").write.mode("overwrite" if reread else "append").parquet(known_path)
        known = spark.read.schema(_PART_DIGESTS).parquet(known_path)
    held = known.join(present.select(*same), same, "left_semi").dropDuplicates([*same, "run_id"])
    return I.added_up(held, "run_id", "batch", "table").select(
        "run_id", "batch", F.concat("table", F.lit(".parquet")).alias("name"), "rows", "sha256"
    )


def batch_digests(spark: SparkSession, root: str, batch: str) -> DataFrame:
    """Row counts and content digests of one batch, per run and table."""
    return stored_digests(spark, root).where(F.col("batch") == batch).drop("batch")


def recorded_batch_digests(spark: SparkSession, root: str, manifests: DataFrame, reread: bool = False) -> DataFrame:
    """Digests of the batch each run's manifest names, whatever its status."""
    keys = manifests.select("run_id", F.col("derived_version").alias("batch"))
    return stored_digests(spark, root, reread).join(keys, ["run_id", "batch"], "left_semi").drop("batch")


_SOURCES = "run_id string, name string, size bigint, modified bigint, sha256 string"


def write_sources(identity: DataFrame, root: str, batch: str) -> None:
    """The identity of a batch's source files, file by file and as roots of runs."""
    path = f"{root}/sources/batch={batch}"
    identity.write.mode("overwrite").parquet(path)
    I.run_roots(identity.sparkSession.read.schema(_SOURCES).parquet(path)).write.mode("overwrite").parquet(f"{root}/roots/batch={batch}")


def recorded_identity(spark: SparkSession, root: str, manifests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Source files and run roots as recorded for the batch that each run's manifest names."""
    keys = manifests.select("run_id", F.col("derived_version").alias("batch"))
    return tuple(
        (spark.read.schema(f"{schema}, batch string").parquet(f"{root}/{name}") if _exists(spark, f"{root}/{name}")
         else spark.createDataFrame([], f"{schema}, batch string")).join(keys, ["run_id", "batch"], "left_semi").drop("batch")
        for name, schema in (("sources", _SOURCES), ("roots", "run_id string, day string, root string"))
    )


def build_manifests(run: DataFrame, sources: DataFrame, digests: DataFrame, batch: str) -> DataFrame:
    """Manifest rows: versions, status, source hashes, and counts and digests of all outputs.

    A run has a few hundred source files and exactly seven outputs, so the lists are bounded.
    """
    files = sources.groupBy("run_id").agg(
        F.array_sort(F.collect_list(F.struct("name", "size", "sha256"))).alias("source_files")
    )
    names = F.explode(F.array(*[F.lit(f"{t}.parquet") for t in C.DERIVED_TABLES])).alias("name")
    outputs = (
        run.select("run_id", names).join(digests, ["run_id", "name"], "left")
        .groupBy("run_id").agg(
            F.array_sort(
                F.collect_list(F.struct("name", F.coalesce("rows", F.lit(0)).alias("rows"), "sha256"))
            ).alias("outputs")
        )
    )
    return run.join(files, "run_id", "left").join(outputs, "run_id").select(
        F.col("derived_schema_id").alias("schema_id"), F.lit(batch).alias("derived_version"),
        "extractor_version", "tshark_version", "run_id", "source_path",
        F.struct(
            F.col("classification").alias("membership"), "attempt_state", "run_status", "started_utc",
            "eligible", "input_complete",
        ).alias("classification"),
        F.col("extraction_status").alias("status"),
        F.array_compact(F.array("error")).alias("errors"),
        "source_files", "outputs",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("manifest_written_utc"),
    )


def write_manifests(manifests: DataFrame, root: str, batch: str) -> None:
    """Write a batch's manifests.  Done last: only then do the outputs of the batch count."""
    manifests.write.mode("overwrite").json(f"{root}/manifests/{batch}")

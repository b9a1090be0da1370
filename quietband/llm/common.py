"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietband.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(rows: DataFrame, label: str, *partition_by: str, compression: str = "snappy") -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, and lost executors cost no earlier step."""
    spark = rows.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    writer = rows.write.option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def input_bytes(rows: DataFrame) -> int:
    """Bytes of the files below a relation, as the optimizer knows them; no job runs."""
    return int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def text_slices(text: pa.Array, limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with at most `limit` bytes of text each; one long text is a range of its own."""
    n = len(text)
    if not n:
        return
    ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(text), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield at, to
        at = to


def flat_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end with a space after each text, and where each text starts.

    A null counts as an empty text. The space keeps words of neighbouring texts apart.
    """
    parts = [x or b"" for x in pa.compute.cast(text, pa.binary()).to_pylist()]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    return np.frombuffer(b" ".join([*parts, b""]), np.uint8), starts


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).view(np.int8)))
    return edge[::2], edge[1::2]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, at least n of each."""
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for k, b in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def span_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each byte span, mixed; equal spans have equal hashes."""
    up, down = _power_tables(len(flat) + 1)
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * up[: len(flat)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(flat: np.ndarray) -> np.ndarray:
    return _LOWER[flat]


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))

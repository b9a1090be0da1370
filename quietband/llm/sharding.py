"""Sharding by a K-d tree over document metadata."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quietband.llm.common import stored, text_or_empty

#: Buckets of one narrowing pass per tree node.
FANOUT = 4096
#: Node tables up to this many rows (some MB) are broadcast. Beyond it a node holds about 1/65536 of the bytes at most,
#: so a shuffle on the node id is even.
BROADCAST_NODES = 65_536
#: Rows that are numbered together.
NUMBERED_ROWS = 50_000


def metadata_dimensions() -> dict[str, Column]:
    """Dimensions of the documents table: names become numbers by their CRC-32."""
    return {
        "bytes": F.octet_length(text_or_empty()).cast("long"),
        "source": F.crc32(F.coalesce("source", F.lit("")).cast("binary")),
        "lang": F.crc32(F.coalesce("lang", F.lit("")).cast("binary")),
    }


def _with_nodes(rows: DataFrame, nodes: list[tuple], schema: str, how: str = "inner") -> DataFrame:
    table = rows.sparkSession.createDataFrame(nodes, schema)
    return rows.join(F.broadcast(table) if len(nodes) <= BROADCAST_NODES else table, "node", how)


def _narrow(rows: DataFrame, key: str, nodes: dict[int, dict]) -> None:
    """Set `cut` of each node to the key value at which the running weight reaches the node's target.

    Every pass histograms the interval that holds the cut; only sums leave the executors, at most FANOUT per node,
    and of these one row per node comes to the driver.
    """
    todo = {n: x for n, x in nodes.items() if x["lo"] < x["hi"]}
    while todo:
        held = _with_nodes(
            rows,
            [(n, x["lo"], x["hi"], -(-(x["hi"] - x["lo"] + 1) // FANOUT), x["target"] - x["below"]) for n, x in todo.items()],
            "node long, lo long, hi long, width long, missing double",
        ).where(F.col(key).between(F.col("lo"), F.col("hi")))
        sums = held.groupBy("node", F.expr(f"({key} - lo) div width").alias("bucket")).agg(
            F.sum("size").alias("weight"), F.first("missing").alias("missing")
        )
        order = Window.partitionBy("node").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        found = (
            sums.withColumn("upto", F.sum("weight").over(order)).where("upto >= missing")
            .groupBy("node").agg(F.min(F.struct("bucket", "upto", "weight")).alias("at")).select("node", "at.*")
        )
        for r in found.collect():
            x = todo[r.node]
            width = -(-(x["hi"] - x["lo"] + 1) // FANOUT)
            x["below"] += r.upto - r.weight
            x["lo"] += r.bucket * width
            x["hi"] = min(x["hi"], x["lo"] + width - 1)
        todo = {n: x for n, x in todo.items() if x["lo"] < x["hi"]}


def kd_shards(
    docs: DataFrame,
    shards: int | None = 8,
    target_bytes: int | None = None,
    dimensions: dict[str, Column] | None = None,
    id_col: str = "doc_id",
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The root holds all rows. A node that still stands for two or more shards is cut at the weighted
    quantile (the median, for an even number) along its widest dimension, measured against the root's extent, until leaves
    stand for one shard. With `target_bytes` the number of shards is the total over that size. The weight of a row is its
    text's UTF-8 bytes plus one. Rows with equal values are told apart by doc_id and then by a row number, so a cut
    never has to move a hot value (one source with a third of all rows, say) as a whole: it misses its target by one row at most.

    The law is `bytes`: sizes of shards are nearly equal. `slot` numbers a shard's rows without gaps from 0, counted in chunks
    of bounded size. Null texts weigh one byte; null names count as empty, null ids as the smallest number. An empty table gives
    an empty result.
    """
    dimensions = dimensions or metadata_dimensions()
    dims = [f"d{k}" for k in range(len(dimensions))]
    text = text_or_empty()
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            *[F.coalesce(c.cast("long"), F.lit(0)).alias(d) for d, c in zip(dims, dimensions.values())],
            F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**62))).alias("tie"),
            F.monotonically_increasing_id().alias("row"),
            F.lit(1).cast("long").alias("node"),
        ),
        "kd-rows",
    )
    keys = [*dims, "tie", "row"]
    extent = [f(k).alias(f"{p}_{k}") for k in keys for p, f in (("min", F.min), ("max", F.max))]
    whole = rows.agg(F.sum("size").alias("weight"), F.count(F.lit(1)).alias("n"), *extent).first()
    if target_bytes:
        shards = max(1, math.ceil((whole.weight or 0) / target_bytes))
    #: Node id -> (shards it stands for, its first shard).
    tree = {1: (shards, 0)}
    leaves: dict[int, int] = {}
    root = {d: max(1, (whole[f"max_{d}"] or 0) - (whole[f"min_{d}"] or 0)) for d in dims}
    level = 0
    while tree and whole.n:
        leaves |= {n: first for n, (k, first) in tree.items() if k == 1}
        tree = {n: x for n, x in tree.items() if x[0] > 1}
        if not tree:
            break
        of = _with_nodes(rows, [(n,) for n in tree], "node long")
        stats = {r.node: r for r in of.groupBy("node").agg(F.sum("size").alias("weight"), *extent).collect()}
        nodes = {}
        for n, (k, _) in tree.items():
            if n in stats:
                r = stats[n]
                d = max(dims, key=lambda d: (r[f"max_{d}"] - r[f"min_{d}"]) / root[d])
                nodes[n] = {
                    "dim": d, "target": r.weight * (k // 2) / k, "below": 0,
                    "lo": r[f"min_{d}"], "hi": r[f"max_{d}"], "cut": [],
                }
        along = F.coalesce(*[F.when(F.col("dim") == d, F.col(d)) for d in dims])
        for depth, name in enumerate(("key", "tie", "row")):
            # Rows of each node that lie at its cut so far, by what tells them apart next.
            at = _with_nodes(
                rows, [(n, x["dim"], *x["cut"]) for n, x in nodes.items()],
                "node long, dim string" + "".join(f", cut{k} long" for k in range(depth)),
            ).withColumn("key", along)
            for k, known in enumerate(("key", "tie")[:depth]):
                at = at.where(F.col(known) == F.col(f"cut{k}"))
            if depth:
                for r in at.groupBy("node").agg(F.min(name).alias("lo"), F.max(name).alias("hi")).collect():
                    nodes[r.node] |= {"lo": r.lo, "hi": r.hi}
            _narrow(at.select("node", "size", name), name, nodes)
            for x in nodes.values():
                x["cut"].append(x["lo"])
        split = _with_nodes(
            rows, [(n, x["dim"], *x["cut"]) for n, x in nodes.items()],
            "node long, dim string, cut0 long, cut1 long, cut2 long", "left",
        )
        left = F.struct(along.alias("a"), F.col("tie").alias("b"), F.col("row").alias("c")) <= F.struct(
            F.col("cut0").alias("a"), F.col("cut1").alias("b"), F.col("cut2").alias("c")
        )
        side = F.when(F.col("dim").isNull(), F.col("node")).otherwise(F.col("node") * 2 + F.when(left, 0).otherwise(1))
        rows = stored(split.select(*[side.alias(c) if c == "node" else F.col(c) for c in rows.columns]), f"kd-level-{level}")
        tree = {
            m: y
            for n, (k, first) in tree.items()
            for m, y in ((2 * n, (k // 2, first)), (2 * n + 1, (k - k // 2, first + k // 2)))
        }
        level += 1
    placed = _with_nodes(rows, list(leaves.items()) or [(1, 0)], "node long, shard int")
    return _numbered(placed, max(1, whole.n // NUMBERED_ROWS)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _numbered(rows: DataFrame, chunks: int) -> DataFrame:
    """Adds slot: gapless numbers within each shard, without gathering a shard in one task."""
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    here = Window.partitionBy("shard", "chunk").orderBy("tie", "row")
    numbered = rows.withColumn("at", F.row_number().over(here) - 1)
    return numbered.join(offsets, ["shard", "chunk"]).withColumn("slot", (F.col("offset") + F.col("at")).cast("long"))

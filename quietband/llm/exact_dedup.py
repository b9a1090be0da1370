"""Exact deduplication by distributed MSD radix partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietband.llm.common import stored, text_or_empty

#: Bytes of the first digit, and how much longer each later digit is.
FIRST_BLOCK, GROWTH = 64, 4


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Documents are split by their first bytes, and every group of two or more by its next bytes, until a
    group is a singleton or its texts have ended: then its texts are equal byte for byte. No digest
    decides anything (`text_sha256` is only reported). Successive digits are 64, 256, 1024, ... bytes long,
    so a text of n bytes takes part in at most log4(n) rounds, and a document leaves at the first digit
    that nobody shares. Each round counts groups with map-side combining, so a group of copies of any
    size shrinks to a row per task before the shuffle, and the join that hands out group ids has
    unique keys on the group side, which lets the adaptive plan split a hot group's rows.

    Null text counts as empty. The largest doc_id of a group stays; null ids are smaller than all others, and of
    rows that repeat one id with one text exactly one is `kept`. Other columns, whatever their names, are ignored.
    An empty table gives an empty result.
    """
    text = text_or_empty(text_col)
    state = docs.select(
        F.col(id_col).alias("doc_id"),
        F.sha2(text.cast("binary"), 256).alias("text_sha256"),
        F.lit(0).cast("long").alias("group"),
        text.cast("binary").alias("rest"),
    )
    size, finished, round_ = FIRST_BLOCK, [], 0
    while True:
        block = F.substring("rest", 1, size)
        groups = stored(
            state.groupBy("group", block.alias("block"))
            .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id"))
            .where("n > 1")
            # Ids are handed out once and then read from the table, so all later steps agree on them.
            .withColumn("next_group", F.monotonically_increasing_id()),
            f"radix-groups-{round_}",
        )
        alone, ended = F.col("n").isNull(), F.length("block") < size
        step = stored(
            state.withColumn("block", block).join(groups.hint("merge"), ["group", "block"], "left").select(
                "doc_id", "text_sha256",
                F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                F.col("next_group").alias("group"),
                F.lit(round_).alias("round"),
                F.monotonically_increasing_id().alias("row"),
                F.when(~alone & ~ended, F.substring(F.col("rest"), size + 1, 2**31 - 1 - size)).alias("rest"),
                (alone | ended).alias("done"),
            ),
            f"radix-{round_}", "done",
        )
        finished.append(step.where("done"))
        state = step.where("not done").select("doc_id", "text_sha256", "group", "rest")
        if state.isEmpty():
            break
        size, round_ = size * GROWTH, round_ + 1

    rows = reduce(DataFrame.unionByName, finished)
    rows = rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    # Rows that repeat both id and text: all but the first one written go.
    repeats = (
        rows.where("kept and group_size > 1").groupBy("round", "group")
        .agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    )
    if not repeats.isEmpty():
        rows = rows.join(repeats, ["round", "group"], "left").withColumn(
            "kept", F.col("kept") & (F.col("first").isNull() | (F.col("first") == F.col("row")))
        )
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")

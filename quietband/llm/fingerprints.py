"""Document fingerprints: invertible Bloom lookup tables of paragraph digests. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quietband.llm.common import stored, text_or_empty

#: A paragraph is a line; longer ones are cut after so many words.
PARAGRAPH = r"(?:\S++[^\S\n]*+){1,24}+\n?"
#: Cells of one table: three groups of four; a digest has a cell in each.
CELLS = 12
#: Ids whose neighbours are looked for together.
NEIGHBOURS = 1024
_CHECK = (1 << 20) - 1


def paragraph_digests(text: Column) -> Column:
    """The distinct 64-bit digests of a text's paragraphs; the low 20 bits check the others."""
    def digest(part: Column) -> Column:
        key = F.xxhash64(F.btrim(part, F.lit(" \t\r\n"))).bitwiseAND(F.lit(~_CHECK))
        return key.bitwiseOR(F.xxhash64(key).bitwiseAND(F.lit(_CHECK)))

    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), digest))


def _is_digest(word: Column) -> Column:
    return F.xxhash64(word.bitwiseAND(F.lit(~_CHECK))).bitwiseAND(F.lit(_CHECK)) == word.bitwiseAND(F.lit(_CHECK))


def _cell(word: Column, group: int, attempt: int) -> Column:
    """The digest's cell in a group; a retry reads other bits."""
    return F.shiftrightunsigned(word, 20 + (6 * attempt + 2 * group) % 38).bitwiseAND(F.lit(3)).cast("int") + 4 * group


def cells(word: Column, sign: Column, attempt: int = 0) -> list[Column]:
    """Aggregates that build a table: per cell the sum of signs and the XOR of digests. Signs of two versions subtract them."""
    out = []
    for c in range(CELLS):
        here = _cell(word, c // 4, attempt) == c
        out += [
            F.sum(F.when(here, sign).otherwise(0)).cast("int").alias(f"n{c}"),
            F.bit_xor(F.when(here, word).otherwise(F.lit(0).cast("long"))).alias(f"w{c}"),
        ]
    return out


def peel(attempt: int) -> Column:
    """Struct (table, plus, minus) left after peeling the cells n0, w0, ... of a difference.

    A cell with a count of one or minus one and a word that is a digest gives that digest; it is counted and taken out of its
    cells, which may lay open others. All cells are zero at the end exactly if all digests were found.
    """
    table = F.array(*[F.struct(F.col(f"n{c}").alias("n"), F.col(f"w{c}").alias("w")) for c in range(CELLS)])
    start = F.struct(table.alias("table"), F.lit(0).alias("plus"), F.lit(0).alias("minus"))

    def step(state: Column, _: Column) -> Column:
        open_ = F.get(F.filter(state["table"], lambda x: (F.abs(x["n"]) == 1) & _is_digest(x["w"])), F.lit(0))
        word, sign = open_["w"], open_["n"]
        at = [_cell(word, g, attempt) for g in range(3)]
        rest = F.transform(state["table"], lambda x, i: F.when(
            (i == at[0]) | (i == at[1]) | (i == at[2]),
            F.struct((x["n"] - sign).alias("n"), x["w"].bitwiseXOR(word).alias("w")),
        ).otherwise(x))
        return F.when(open_.isNull(), state).otherwise(F.struct(
            rest.alias("table"), (state["plus"] + F.when(sign == 1, 1).otherwise(0)).alias("plus"),
            (state["minus"] + F.when(sign == -1, 1).otherwise(0)).alias("minus"),
        ))

    return F.aggregate(F.sequence(F.lit(1), F.lit(CELLS)), start, step)


def _part(word: Column, bits: Column) -> Column:
    """Which of 2**bits tables a digest belongs to."""
    return F.when(bits == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", word, 64 - bits))


def differences(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, plus, minus): how many digests only `a` and only `b` of each pair has, recovered from subtracted tables.

    `a` and `b` are arrays of distinct digests. A pair starts with about one table per two digests of its larger side, told apart by
    their first bits. Tables that cannot be peeled to the end are built anew, eight for one and with other cells, until all
    are. All work on a pair happens where its row is; only rows with such tables go on to the next round.
    """
    spark = pairs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    larger = F.greatest(F.size("a"), F.size("b"))
    todo = pairs.select(*keys, F.greatest(F.ceil(F.log2(F.greatest(larger, F.lit(1)) / 2)), F.lit(0)).cast("int").alias("bits"), "a", "b")
    found, attempt = [], 0
    while True:
        here = todo.repartition(parts, *keys)
        signed = F.concat(
            F.transform("a", lambda w: F.struct(w.alias("w"), F.lit(1).alias("sign"))),
            F.transform("b", lambda w: F.struct(w.alias("w"), F.lit(-1).alias("sign"))),
        )
        words = here.select(*keys, "bits", F.explode(signed).alias("x")).select(
            *keys, _part(F.col("x.w"), F.col("bits")).alias("part"), "x.w", "x.sign"
        )
        tables = words.groupBy(*keys, "part").agg(*cells(F.col("w"), F.col("sign"), attempt))
        empty = reduce(Column.__and__, [(F.col(f"n{c}") == 0) & (F.col(f"w{c}") == 0) for c in range(CELLS)])
        # Equal parts of both versions have cancelled out already.
        left = tables.where(~empty).select(*keys, "part", peel(attempt).alias("p"))
        done = ~F.exists("p.table", lambda x: (x["n"] != 0) | (x["w"] != 0))
        sums = left.groupBy(*keys).agg(
            F.sum(F.when(done, F.col("p.plus")).otherwise(0)).alias("plus"),
            F.sum(F.when(done, F.col("p.minus")).otherwise(0)).alias("minus"),
            F.collect_list(F.when(~done, F.col("part"))).alias("again"),
        )
        step = stored(
            here.join(sums.hint("merge"), keys, "left").select(
                *keys, (F.col("bits") + 3).alias("finer"),
                F.coalesce("plus", F.lit(0)).alias("plus"), F.coalesce("minus", F.lit(0)).alias("minus"),
                *[
                    F.when(F.size("again") > 0, F.filter(v, lambda w: F.array_contains("again", _part(w, F.col("bits"))))).alias(v)
                    for v in ("a", "b")
                ],
            ),
            f"sketch-{attempt}",
        )
        found.append(step.select(*keys, "plus", "minus"))
        todo = step.where("a is not null or b is not null").select(*keys, F.col("finer").alias("bits"), "a", "b")
        attempt += 1
        if todo.isEmpty():
            break
    if len(found) == 1:
        return found[0]
    return reduce(DataFrame.unionByName, found).groupBy(*keys).agg(F.sum("plus").alias("plus"), F.sum("minus").alias("minus"))


def _successors(keys: DataFrame, key: str) -> DataFrame:
    """(key, after): the next larger key, after the largest the smallest; ordered by ranges, no task holds all keys."""
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(keys.repartitionByRange(parts, key).withColumn("range", F.spark_partition_id()), "neighbour-ranges")
    # One row per range.
    ends = ranged.groupBy("range").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    order = Window.partitionBy(F.lit(0)).orderBy("range")
    whole = Window.partitionBy(F.lit(0))
    links = ends.select("range", F.coalesce(F.lead("low").over(order), F.min("low").over(whole)).alias("next_low"))
    inside = F.lead(key).over(Window.partitionBy("range").orderBy(key))
    return ranged.withColumn("inside", inside).join(links, "range").select(key, F.coalesce("inside", "next_low").alias("after"))


def fingerprint(digests: str) -> Column:
    """A text's own table of CELLS cells, as text: its number of paragraphs, then count and XOR of each cell. Built in the row."""
    def cell(c: int) -> Column:
        held = F.filter(digests, lambda w: _cell(w, c // 4, 0) == c)
        return F.concat(
            F.lit("."), F.hex(F.size(held)), F.lit(":"),
            F.hex(F.aggregate(held, F.lit(0).cast("long"), lambda a, w: a.bitwiseXOR(w))),
        )

    return F.concat(F.hex(F.size(digests)), *[cell(c) for c in range(CELLS)])


def compare_with_edit_and_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 4) code points replaced by as many, or all, of the next document's first ones. Next
    is by ascending doc_id, after the last document the first; rows of one id are ordered by a hash of their text, null ids come
    first. Likeness is the Jaccard similarity of the two sets of paragraph digests, from the differences that the subtracted
    tables give back; two texts without paragraphs are alike (1). Null text counts as empty. An empty table gives an empty
    result. Other columns are ignored.

    Documents of NEIGHBOURS successive ids meet in one task, whatever the ids' distribution; the first text of each such
    range goes to the range before. Whole texts are shuffled once, after that only digests.
    """
    text = text_or_empty(text_col)
    base = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"),
        F.coalesce(F.expr(f"floor(`{id_col}` / {NEIGHBOURS})").cast("long"), F.lit(-(2**62))).alias("bucket"),
    )
    order = [F.col("doc_id"), F.xxhash64("text")]
    firsts = base.groupBy("bucket").agg(F.min_by("text", F.struct(*order)).alias("first_text"))
    firsts = stored(firsts, "neighbour-firsts")
    after = firsts.join(_successors(firsts.select("bucket"), "bucket").withColumnRenamed("bucket", "own"),
                        F.col("bucket") == F.col("after")).select(F.col("own").alias("bucket"), F.col("first_text").alias("after_text"))
    window = Window.partitionBy("bucket").orderBy(*order)
    rows = (
        base.withColumn("digests", paragraph_digests(F.col("text")))
        .select("*", F.row_number().over(window).alias("row"), F.lead("text").over(window).alias("next"),
                F.lead("digests").over(window).alias("next_digests"))
        .join(after.hint("merge"), "bucket")
    )
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    follower = F.coalesce("next", "after_text")
    rows = rows.select(
        "bucket", "row", "doc_id", n.cast("long").alias("n_chars"), "digests",
        F.concat(F.substring("text", F.lit(1), n - cut), F.substring(follower, F.lit(1), cut)).alias("edited"),
        F.when(F.col("next").isNull(), paragraph_digests(F.col("after_text"))).otherwise(F.col("next_digests")).alias("next_digests"),
    ).withColumn("edited_digests", paragraph_digests(F.col("edited")))
    kept = stored(
        rows.select(
            "bucket", "row", "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            fingerprint("digests").alias("fingerprint"), fingerprint("edited_digests").alias("edited_fingerprint"),
            "digests", "edited_digests", "next_digests",
        ),
        "sketch-rows", compression="zstd",
    )
    key = ["bucket", "row", "kind"]
    pairs = kept.select("bucket", "row", F.explode(F.array(
        F.struct(F.lit("edited").alias("kind"), F.col("digests").alias("a"), F.col("edited_digests").alias("b")),
        F.struct(F.lit("next").alias("kind"), F.col("digests").alias("a"), F.col("next_digests").alias("b")),
    )).alias("p")).select("bucket", "row", "p.kind", "p.a", "p.b")
    sizes = kept.select("bucket", "row", "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                        F.size("digests").alias("size"))
    found = differences(pairs, key).groupBy("bucket", "row").agg(*[
        F.max(F.when(F.col("kind") == kind, F.col(side))).alias(f"{side}_{kind}") for kind in ("edited", "next") for side in ("plus", "minus")
    ])

    def likeness(kind: str) -> Column:
        union = F.col("size") + F.col(f"minus_{kind}")
        return F.when(union == 0, F.lit(1.0)).otherwise((F.col("size") - F.col(f"plus_{kind}")) / union).alias(f"near_{kind}")

    return sizes.join(found.hint("merge"), ["bucket", "row"]).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness("edited"), likeness("next")
    )

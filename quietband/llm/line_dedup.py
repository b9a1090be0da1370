"""Fuzzy line deduplication: MinHashes of windows of character shingles, exact verification, union-find. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quietband.llm.common import stored, text_or_empty
from quietband.llm.components import components

#: Characters of a shingle, and how many neighbouring shingles are hashed together.
SHINGLE, WIDE = 16, 8
#: Similarity in percent from which two lines are near copies.
PERCENT = 80
#: Half of a shingle, and how far a mark's core reaches from its blank: less than HALF - 3.
HALF, REACH = SHINGLE // 2, 2
#: Lines that share one hash are a crowd beyond this number.
CROWD = 32
#: Members of a crowd that all others are compared with first, in each of so many rounds.
HEADS, ROUNDS = 8, 2
#: 64-bit words of a line's parities, a power of two; columns that a line carries besides its tokens.
WORDS = 8
KNOWN = ("least", "most", "marks", "need", *[f"odd{w}" for w in range(WORDS)])
#: Key tables up to this many rows (some 90 MB at most) are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Spark's setting by which shuffle files go at the end of a write.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Keys that the places of one component are dealt over.
SALTS = 16


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, tie, pos, line, line_id) of every line that is not blank, at any length."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("tie"),
        F.posexplode(F.split(text_or_empty(text_col), "\n")).alias("pos", "line"),
    )
    rows = rows.select("doc_id", "tie", "pos", F.btrim("line", F.lit(" \t\r")).alias("line"))
    return rows.where("line != ''").withColumn("line_id", F.xxhash64("line"))


def _of_shingles(line: Column, value: Callable[[Column], Column]) -> Column:
    """The distinct values of the SHINGLE characters from every offset of a line, in UTF-16; a shorter line is one.

    Two bytes hold a character, so that an offset is a place in them. In lines with others one pass finds blocks that hold the
    characters of WIDE offsets, so the work grows with the line's length and not with its square.
    """
    offsets = F.length(line) - (SHINGLE - 1)
    # Bound to a variable: inside the loop the line would be encoded again for every offset.
    plain = F.transform(F.array(F.encode(line, "UTF-16BE")), lambda b: F.transform(
        F.sequence(F.lit(1), 2 * offsets - 1, F.lit(2)), lambda i: value(F.substring(b, i, F.lit(2 * SHINGLE)))
    ))
    blocks = F.regexp_extract_all(
        F.concat(line, F.lit("\0" * (WIDE - 1))), F.lit(f"(?s)(?=(.{{{SHINGLE + WIDE - 1}}})).{{{WIDE}}}"), F.lit(1)
    )
    others = F.transform(blocks, lambda x: F.array(*[value(F.encode(F.substring(x, j + 1, SHINGLE), "UTF-16BE")) for j in range(WIDE)]))
    values = F.when(_wide(line), F.slice(F.flatten(others), F.lit(1), offsets)).otherwise(F.get(plain, F.lit(0)))
    return F.when(F.length(line) < SHINGLE, F.array(value(F.encode(line, "UTF-16BE")))).otherwise(F.array_distinct(values))


def _wide(line: Column) -> Column:
    """Whether a line has characters that take four bytes of UTF-16."""
    return line.rlike(r"[\x{10000}-\x{10FFFF}]")


def shingle_hashes(line: Column) -> Column:
    """Hashes of the distinct character shingles."""
    return _of_shingles(line, F.xxhash64)


def _ranked(shingle: Column) -> Column:
    """A hash that is smaller for shingles of fewer blanks: those of long words are rarer than those of short ones, or of one repeated."""
    text = F.decode(shingle, "UTF-16BE")
    blanks = F.least(F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))), F.lit(7))
    return F.shiftrightunsigned(F.xxhash64(shingle), 3).bitwiseOR(F.call_function("shiftleft", (blanks - 4).cast("bigint"), F.lit(61)))


def _sketch(hashes: Column) -> Column:
    """The smallest hashes of a set: of two sets that are alike by PERCENT, both sketches hold their smallest
    common hash, since what is not common to both is at most the rest of each.
    """
    n = F.size(hashes)
    return F.slice(F.sort_array(hashes), F.lit(1), n - F.ceil(n * PERCENT / F.lit(100)).cast("int") + 1)


def _around_blanks(line: Column) -> Column:
    """The SHINGLE characters around every blank, which is the last of their first half; NULs stand outside the line."""
    padded = F.concat(F.lit("\0" * (HALF - 1)), line, F.lit("\0" * HALF))
    # Looking back from the blanks is faster, but counts a character beyond the basic plane as two.
    ahead = F.lit(f"(?s)(?=(.{{{HALF - 1}}} .{{{HALF}}})).")
    back = F.lit(f"(?s) (?<=(?=(.{{{SHINGLE}}})).{{{HALF}}})")
    return F.when(_wide(line), F.regexp_extract_all(padded, ahead, F.lit(1))).otherwise(F.regexp_extract_all(padded, back, F.lit(1)))


def _core(around: Column) -> Column:
    """Hash of the characters from REACH before the blank to REACH + 1 behind it."""
    return F.xxhash64(F.substring(around, HALF - REACH, 2 * REACH + 2))


def _twice(around: Column) -> Column:
    """Cores that stand at several blanks of a line."""
    # Bound to a variable: inside the loop an expression would be made again for every blank.
    ordered = F.array(F.sort_array(F.transform(around, _core)))
    return F.get(F.transform(ordered, lambda all_: F.filter(all_, lambda h, i: h == F.get(all_, i + 1))), F.lit(0))


def _enough(offsets: Column) -> Column:
    """How many marks of a line with a core that stands once in it, less by one, hold one that every line alike by PERCENT has.

    Be f and g the shingles that only this line and only the other one has. With p for PERCENT, 100 f + p g is (100 - p) times the
    line's shingles at most. Take such a mark that the other line has not, and go back in the row of foreign shingles that holds it
    to the first of them. If that is HALF - REACH - 1 places back or more, as many shingles and the mark, all with this core, are
    foreign; no other place has them, and those of other marks are others, since the blanks of marks are HALF - 2 apart at least. If
    not, the other line has the shingle before the first, which ends with the core or goes on behind it, and parts from this line
    there. HALF - REACH of its shingles at least hold the core and the character that is different, so they are foreign to this line.
    They belong to this row alone: of two that one shingle belonged to, the later would part behind a shingle of both lines with the
    core of the earlier and its different character. So each mark costs `least`. Only the row at this line's start and that where the
    other line ends may cost no more than the mark itself.
    """
    least = min(100 + PERCENT * (HALF - REACH), 100 * (HALF - REACH))
    return F.floor(((100 - PERCENT) * offsets + 2 * (least - 100)) / F.lit(least)).cast("int")


def _sketches(lines: DataFrame, order: int) -> DataFrame:
    """(line_id, tokens, least, most, marks, need, odd0, ...): of two lines that are alike by PERCENT, and not equal, both have one token.

    Marks are the shingles around blanks that end words of HALF - 3 characters or more. A line gives its marks in ascending order of
    the hashes of their cores, up to that which is enough; one of them at least is common to both lines, so both give the
    smallest mark that they have in common. A line with too few marks gives all, so that of a line of the first
    kind among them, and the smallest hashes of all its shingles, which it shares with its like. Lines of fewer than SHINGLE
    characters have one shingle that no other line has.

    least and most bound the number of a line's shingles, marks is that of its marks, need how many of them any line has that is alike, and odd0, ... tell for each of
    64 * WORDS bits whether an odd number of them fall on it.
    """
    rows = lines.where(F.length("line") >= SHINGLE).select(
        "line_id", "line", (F.length("line") - (SHINGLE - 1)).alias("offsets"), _around_blanks(F.col("line")).alias("around")
    )
    marks = F.filter("around", lambda s: (F.locate(" ", s, 3) == HALF) & (F.locate("\0", s) == 0))
    rows = rows.select("line_id", "line", "offsets", _twice(F.col("around")).alias("twice"), marks.alias("marks"))
    once = F.sort_array(F.array_except(F.transform("marks", _core), "twice"))
    hashes = F.array_distinct(F.transform("marks", lambda s: F.xxhash64(s, F.lit(order))))
    rows = rows.select("line_id", "line", "marks", _enough(F.col("offsets")).alias("enough"), once.alias("once"), hashes.alias("hashes"))
    rows = rows.withColumn("cut", F.get("once", F.col("enough")))
    few = F.col("cut").isNull()
    rows = rows.withColumn("all", F.when(few, _of_shingles(F.col("line"), _ranked)))
    tokens = F.transform(F.filter("marks", lambda s: _core(s) <= F.col("cut")), lambda s: F.xxhash64(s, F.lit(order)))
    tokens = F.when(few, F.concat("hashes", _sketch(F.col("all")))).otherwise(tokens)

    def odd(word: int) -> Column:
        bit = lambda h: F.when(F.shiftright(h, 6).bitwiseAND(F.lit(WORDS - 1)) == word, F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(F.lit(63)).cast("int"))).otherwise(F.lit(0).cast("bigint"))
        return F.aggregate("hashes", F.lit(0).cast("bigint"), lambda bits, h: bits.bitwiseXOR(bit(h)))

    return rows.select(
        "line_id", F.array_distinct(tokens).alias("tokens"), F.when(few, F.size("all")).otherwise(0).alias("least"),
        F.when(few, F.size("all")).otherwise(F.length("line") - (SHINGLE - 1)).alias("most"), F.size("hashes").alias("marks"),
        F.greatest(F.size("once") - F.col("enough"), F.lit(0)).alias("need"), *[odd(w).alias(f"odd{w}") for w in range(WORDS)],
    )


def _sketched(lines: DataFrame, order: int) -> DataFrame:
    """(line_id, token): the tokens as rows."""
    return _sketches(lines, order).select("line_id", F.explode("tokens").alias("token"))


def _may_be_alike(x: str, y: str) -> Column:
    """Whether two lines can be of near sizes and have as many common marks as each needs; bits with different parities are no more
    than the marks that are not common. x and y begin the names of their columns.
    """
    near = (100 * F.col(f"{x}most") >= PERCENT * F.col(f"{y}least")) & (100 * F.col(f"{y}most") >= PERCENT * F.col(f"{x}least"))
    odd = [F.bit_count(F.col(f"{x}odd{w}").bitwiseXOR(F.col(f"{y}odd{w}"))) for w in range(WORDS)]
    return near & (F.col(f"{x}marks") + F.col(f"{y}marks") - reduce(Column.__add__, odd) >= 2 * F.greatest(f"{x}need", f"{y}need"))


def _named(rows: DataFrame, x: str, line: str, *rest: str) -> DataFrame:
    """Lines with what is known of their marks under names that begin with x."""
    return rows.select(*rest, F.col("line_id").alias(line), *[F.col(c).alias(f"{x}{c}") for c in KNOWN])


def _alike(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The pairs (a, b) whose lines are alike by PERCENT, compared exactly: lines of n and m shingles that have
    PERCENT / (100 + PERCENT) of n + m in common at least.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("line_id")).distinct()
    line = lines.join(_few(ids), "line_id").select("line_id", "line")
    sizes = stored(line.select("line_id", F.size(shingle_hashes(F.col("line")))), "line-sizes")
    pairs = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    pairs = pairs.where(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")).select("a", "b")
    both = pairs.join(line.toDF("a", "la"), "a").join(line.toDF("b", "lb"), "b")

    common, total = F.size(F.array_intersect("x", "y")), F.size("x") + F.size("y")
    alike = F.when((100 + PERCENT) * common >= PERCENT * total, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    sets = both.select("a", "b", shingle_hashes(F.col("la")).alias("x"), shingle_hashes(F.col("lb")).alias("y"))
    # Not where(): a filter would be moved before the sets, and make them for every use.
    return sets.select("a", "b", F.explode(alike).alias("alike")).select("a", "b")


def _links(shared: DataFrame, sketches: DataFrame, lines: DataFrame) -> DataFrame:
    """Links (a, b) between lines that share a hash; what hangs together by them is exact.

    Members of a crowd are first compared with HEADS of them, so that copies of each other hang together. Of those that then do not,
    all pairs of near sizes are looked at. What is known of both lines' marks, which the rows carry, leaves few pairs to be compared.
    """
    crowds = stored(shared.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > CROWD).select("token"), "line-crowds")
    none = crowds.isEmpty()
    known = stored(shared.join(sketches.drop("tokens"), "line_id").withColumnRenamed("token", "key"), "line-known")
    crowds = crowds.withColumnRenamed("token", "key")
    few = known if none else known.join(crowds, "key", "left_anti")
    pairs = _named(few, "a", "a", "key").join(_named(few, "b", "b", "key"), "key").where((F.col("a") < F.col("b")) & _may_be_alike("a", "b"))
    compared = stored(pairs.select("a", "b").distinct(), "line-near")
    found = stored(_alike(compared, lines), "line-links")
    if none:
        return found

    many = stored(known.join(crowds, "key"), "line-crowded").withColumn("root", F.col("line_id"))
    crowded = many
    for turn in range(ROUNDS):
        # The same lines are heads of all crowds that they are in together.
        by = F.xxhash64("line_id", F.lit(turn))
        chosen = [F.pmod(by, F.lit(HEADS)) == h for h in range(HEADS)]
        heads = F.array_compact(F.array(*[F.min_by(F.when(c, F.col("line_id")), F.when(c, by)) for c in chosen]))
        heads = many.groupBy("key").agg(heads.alias("heads")).select("key", F.explode("heads").alias("line_id"))
        heads = heads.join(many.select("key", "line_id", *KNOWN, "root"), ["key", "line_id"]).withColumnRenamed("root", "other")
        stars = _named(many, "b", "b", "key", "root").join(_named(heads, "a", "a", "key", "other"), "key")
        stars = stars.where((F.col("a") != F.col("b")) & (F.col("root") != F.col("other")) & _may_be_alike("a", "b"))
        stars = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        stars = stored(stars.join(compared, ["a", "b"], "left_anti"), f"line-stars{turn}")
        compared = compared.unionByName(stars)
        found = found.unionByName(stored(_alike(stars, lines), f"line-star-links{turn}"))
        roots = stored(components(found, "a", "b", f"line-known{turn}").select(F.col("node").alias("line_id"), "root"), f"line-roots{turn}")
        many = crowded.drop("root").join(roots, "line_id", "left").withColumn("root", F.coalesce("root", "line_id"))
        # A crowd that hangs together has no more to give.
        low = many.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("key", "low")
        many = many.join(low, "key")
    # What hangs together with the first need not be compared with itself, so of a pair one line at least is none of it.
    # Sizes that are near are of one class or of neighbouring ones; classes are a little wider than they need be, for rounding.
    many = stored(many, "line-apart")
    sized = lines.join(_few(many.select("line_id").distinct()), "line_id").select("line_id", F.size(shingle_hashes(F.col("line"))).alias("n"))
    many = many.join(stored(sized, "line-apart-sizes"), "line_id").withColumns({"least": F.col("n"), "most": F.col("n")})
    size_class = F.floor(F.log("n") / math.log(101 / PERCENT)).cast("int")
    left = _named(many.where("root != low").withColumn("class", size_class), "a", "a", "key", "class", "low", "root")
    right = many.withColumn("class", F.explode(F.array(*[size_class + d for d in (-1, 0, 1)]))).withColumnRenamed("root", "other")
    right = _named(right, "b", "b", "key", "class", "other")
    once = (F.col("other") == F.col("low")) | (F.col("a") < F.col("b"))
    pairs = left.join(right, ["key", "class"]).where(once & (F.col("root") != F.col("other")) & _may_be_alike("a", "b"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(compared, ["a", "b"], "left_anti")
    return found.unionByName(stored(_alike(stored(pairs, "line-open"), lines), "line-open-links"))


def _few(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tie, gone): positions of the lines to take out of each document that has such lines.

    Lines hang together when they are equal (without outer blanks) or when the Jaccard similarity of their character
    shingles is PERCENT or more and a chain of such pairs joins them. Of each component the line with the smallest
    (doc_id, text hash, position) stays.

    Equal lines share an id and are one line to all later steps. Lines that are alike share one of the hashes that each keeps, so
    candidates are all lines that share one, and no link is left out. Texts of distinct lines are kept once, and read again for those
    alone that share a hash or are compared; the places of lines that repeat or have links are found in a second pass.
    """
    lines = _lines(docs, id_col, text_col)
    distinct = stored(lines.select("line_id", "line").dropDuplicates(["line_id"]), "line-distinct", compression="zstd")
    sketches = stored(_sketches(distinct, 0), "line-sketches")
    by_token = Window.partitionBy("token")
    shared = stored(
        sketches.select("line_id", F.explode("tokens").alias("token"))
        .withColumns({"low": F.min("line_id").over(by_token), "high": F.max("line_id").over(by_token)})
        .where("low != high").select("token", "line_id"),
        "line-shared",
    )
    links = _links(shared, sketches, distinct)
    roots = stored(components(links, "a", "b", "line-links").select(F.col("node").alias("line_id"), "root"), "line-components")
    repeats = lines.groupBy("line_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("line_id")
    wanted = stored(repeats.unionByName(roots.select("line_id")).distinct(), "line-wanted")
    found = lines.select("doc_id", "tie", "pos", "line_id").join(_few(wanted), "line_id")

    place = F.struct("doc_id", "tie", "pos").alias("place")
    placed = stored(
        found.join(roots, "line_id", "left")
        # The places of one component, which may be a third of all, are dealt over SALTS keys.
        .select(place, F.coalesce("root", "line_id").alias("root"), F.pmod(F.xxhash64("doc_id", "tie", "pos"), F.lit(SALTS)).alias("salt")),
        "line-roots",
    )
    within = placed.groupBy("root", "salt").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    first = (
        within.groupBy("root").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .where(~F.col("first").eqNullSafe(F.col("last")))
        .select("root", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt"), "first")
    )
    gone = placed.join(first, ["root", "salt"]).where(~F.col("place").eqNullSafe(F.col("first")))
    return gone.groupBy("place.doc_id", "place.tie").agg(F.collect_set("place.pos").alias("gone"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None
) -> DataFrame:
    """The documents with repeated and near-repeated lines taken out, and lines_before, lines_gone.

    Every document stays, with all its columns; a document whose lines all go has an empty text, a null text stays null. Rows
    that repeat one id with one text count as one document. Null ids come first in the order. An empty table gives an
    empty result. `length_col` names a column that holds the number of characters and follows the text. Other columns may have any name but lines_before and lines_gone, which are replaced.
    """
    conf = docs.sparkSession.conf
    kept = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")  # a step that is stored needs its shuffle no more
    try:
        gone = stored(repeated_lines(docs, id_col, text_col), "line-gone").select(
            F.col("doc_id").alias("__doc"), F.col("tie").alias("__tie"), F.col("gone").alias("__gone")
        )
    finally:
        conf.set(CLEANUP, kept)
    rest = [c for c in docs.columns if c not in ("lines_before", "lines_gone")]
    rows = docs.select(*rest, F.xxhash64(text_col).alias("__own"))
    rows = rows.join(
        # The same join at every size.
        gone.hint("merge"), F.col(id_col).eqNullSafe(F.col("__doc")) & (F.col("__own") == F.col("__tie")), "left"
    )
    lines = F.split(F.col(text_col), "\n")

    def without_gone(own: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), F.col("__gone"))
        return F.array_join(F.transform(stay, lambda i: F.get(own, i)), "\n")

    # The lines are bound to a variable: inside the loop an expression would split the text again for every line.
    left = F.get(F.transform(F.array(lines), without_gone), F.lit(0))
    rows = rows.withColumn("__left", F.when(F.col("__gone").isNotNull(), left))
    changed = {text_col: F.col("__left")}
    if length_col in rest:
        changed[length_col] = F.length("__left").cast(docs.schema[length_col].dataType)
    return rows.select(
        *[F.when(F.col("__gone").isNull(), F.col(c)).otherwise(changed[c]).alias(c) if c in changed else F.col(c) for c in rest],
        F.coalesce(F.octet_length(text_col) - F.octet_length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))) + 1, F.lit(0))
        .cast("long").alias("lines_before"),
        F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long").alias("lines_gone"),
    )

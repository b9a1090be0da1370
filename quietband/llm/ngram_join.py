"""N-gram Jaccard self-join with several global token orders."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietband.llm.common import flat_bytes, input_bytes, lower_ascii, mix, runs_of, span_hashes, stored, text_slices
from quietband.llm.components import components

#: Input bytes per token bucket, and tokens that one chunk of documents or one verification block holds.
BUCKET_BYTES, CHUNK_TOKENS, BLOCK_TOKENS = 1 << 24, 1 << 21, 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ORDERS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA5A3564E27F8863B), np.uint64(0x9FB21C651E98DF25))


def shingle_sets(text: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    Words are runs of `[^\\x20\\x09-\\x0D]` with A-Z lower-cased. A text with fewer words than a shingle has its whole
    sequence as the only one; a text without words, or null, has none.
    """
    flat, starts = flat_bytes(text)
    flat = lower_ascii(flat)
    at, to = runs_of(~_SPACE[flat])
    hashes = span_hashes(flat, at, to)
    first = np.searchsorted(at, starts)
    spread = np.uint64(0x9E3779B97F4A7C15)
    n = len(hashes) - words + 1
    grams = hashes[: max(n, 0)].copy()
    for k in range(1, words):
        grams = mix(grams * spread + hashes[k : k + len(grams)])
    sets = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        if hi - lo >= words:
            sets.append(np.unique(grams[lo : hi - words + 1]))
        elif hi > lo:
            whole = np.array([hi - lo], np.uint64)
            for h in hashes[lo:hi]:
                whole = mix(whole * spread + h)
            sets.append(whole)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _least_overlap(n: np.ndarray | int, percent: int):
    """Tokens that a set of n tokens shares with any set that it links with, at least."""
    return -(-percent * n // 100)


def _index(words: int, buckets: int):
    """documents -> the inverted index in pieces (bucket, src, body) and one header per chunk of documents."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids, sets = [], []

        def flush() -> pa.RecordBatch:
            src = (part << 24) + seq
            sizes = np.array([len(s) for s in sets], np.int32)
            sigs = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            seen = {}
            own = [seen.setdefault(sig, k) == k for k, sig in enumerate(sigs)]
            # Copies within the chunk count once.
            tokens = np.concatenate([s for s, o in zip(sets, own) if o] or [np.zeros(0, np.uint64)])
            docs = np.repeat(np.flatnonzero(own).astype(np.uint64), sizes[own])
            bucket = (tokens >> shift).astype(np.int64)
            packed = ((tokens & np.uint64(0xFFFFFFFFFFFF)) << np.uint64(16)) | docs
            order = np.lexsort((packed, bucket))
            bucket, packed = bucket[order], packed[order]
            cut = np.flatnonzero(np.diff(bucket, prepend=-1))
            # Byte planes of sorted numbers have long runs, which the shuffle's compression takes up.
            rows = [(int(bucket[a]), packed[a:b].view(np.uint8).reshape(-1, 8).T.tobytes()) for a, b in zip(cut, [*cut[1:], len(packed)])]
            return pa.record_batch({
                "bucket": pa.array([b for b, _ in rows] + [buckets + src], pa.int64()),
                "src": pa.array([src] * (len(rows) + 1), pa.int64()),
                "body": pa.array([x for _, x in rows] + [None], pa.binary()),
                "ids": pa.array([None] * len(rows) + [ids], pa.list_(pa.int64())),
                "head": pa.array([None] * len(rows) + [sizes.tobytes() + b"".join(sigs)], pa.binary()),
            })

        for batch in batches:
            text, keys = batch.column(1), batch.column(0).to_pylist()
            for lo, hi in text_slices(text):
                for at, found in enumerate(shingle_sets(text.slice(lo, hi - lo), words), lo):
                    ids.append(keys[at])
                    sets.append(found)
                    held = 0 if len(sets) == 1 else held
                    held += len(found)
                    if held >= CHUNK_TOKENS or len(sets) == 1 << 16:
                        yield flush()
                        seq += 1
                        ids, sets = [], []
        if sets:
            yield flush()

    return run


_INDEX = "bucket long, src long, body binary, ids array<long>, head binary"


def _shared(group: pa.Table) -> pa.Table:
    """One bucket: the tokens that two or more documents have, sent back to each chunk with their document frequency."""
    if group.column("body").null_count:  # a header passes
        return group.append_column("tokens", pa.array([None] * len(group), pa.binary())).drop_columns(["bucket", "body"]).select(
            ["src", "tokens", "ids", "head"])
    bucket = np.uint64(group.column("bucket")[0].as_py())
    planes = [np.frombuffer(x, np.uint8).reshape(8, -1) for x in group.column("body").to_pylist()]
    parts = [np.ascontiguousarray(x.T).view(np.uint64).ravel() for x in planes]
    src = np.repeat(np.array(group.column("src").to_pylist(), np.int64), [len(p) for p in parts])
    packed = np.concatenate(parts)
    order = np.argsort(packed, kind="stable")
    packed, src = packed[order], src[order]
    token = packed >> np.uint64(16)
    cut = np.flatnonzero(np.diff(token, prepend=~token[:1]))
    df = np.repeat(np.diff(np.append(cut, len(token))), np.diff(np.append(cut, len(token))))
    keep = df > 1
    token, df, src, doc = token[keep], df[keep].astype(np.uint32), src[keep], (packed[keep] & np.uint64(0xFFFF)).astype(np.uint16)
    order = np.argsort(src, kind="stable")
    token, df, src, doc = (bucket << np.uint64(48)) | token[order], df[order], src[order], doc[order]
    cut = np.flatnonzero(np.diff(src, prepend=src[:1] - 1))
    spans = list(zip(cut, [*cut[1:], len(src)]))
    return pa.table({
        "src": pa.array([int(src[a]) for a, _ in spans], pa.int64()),
        "tokens": pa.array([token[a:b].tobytes() + df[a:b].tobytes() + doc[a:b].tobytes() for a, b in spans], pa.binary()),
        "ids": pa.array([None] * len(spans), pa.list_(pa.int64())),
        "head": pa.array([None] * len(spans), pa.binary()),
    })


def _head(blob: bytes) -> tuple[np.ndarray, list[bytes]]:
    n = len(blob) // 20
    return np.frombuffer(blob, np.int32, n), [blob[4 * n + 16 * k : 4 * n + 16 * k + 16] for k in range(n)]


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Headers -> one row per document: doc_id, n, sig (null for an empty set)."""
    for batch in batches:
        for ids, head in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sizes, sigs = _head(head)
            yield pa.record_batch({
                "doc_id": pa.array(ids, pa.int64()),
                "n": pa.array(sizes, pa.int64()),
                "sig": pa.array([s if n else None for s, n in zip(sigs, sizes.tolist())], pa.binary()),
            })


def _classes(percent: int):
    """A chunk's header and shared tokens -> the sets that can have partners, with their prefix under every order."""

    def run(group: pa.Table) -> pa.Table:
        heads = [h for h in group.column("head").to_pylist() if h is not None]
        parts = [t for t in group.column("tokens").to_pylist() if t is not None]
        out = {"sig": [], "n": [], "tokens": [], "p0": [], "p1": [], "p2": []}
        if heads and parts:
            sizes, sigs = _head(heads[0])
            k = [len(p) // 14 for p in parts]
            token = np.concatenate([np.frombuffer(p, np.uint64, m) for p, m in zip(parts, k)])
            df = np.concatenate([np.frombuffer(p, np.uint32, m, 8 * m) for p, m in zip(parts, k)])
            doc = np.concatenate([np.frombuffer(p, np.uint16, m, 12 * m) for p, m in zip(parts, k)])
            order = np.lexsort((token, doc))
            token, df, doc = token[order], df[order], doc[order]
            cut = np.flatnonzero(np.diff(doc.astype(np.int32), prepend=-1))
            for a, b in zip(cut, [*cut[1:], len(doc)]):
                n, own, freq = int(sizes[doc[a]]), token[a:b], df[a:b]
                # Tokens of no other document come first in every order.
                left = n - int(_least_overlap(n, percent)) + 1 - (n - len(own))
                if left > 0:
                    out["sig"].append(sigs[doc[a]])
                    out["n"].append(n)
                    out["tokens"].append(own.tobytes())
                    by = (np.lexsort((mix(own * _ORDERS[0]), freq)), *(np.argsort(mix(own * o)) for o in _ORDERS[1:]))
                    for name, o in zip(("p0", "p1", "p2"), by):
                        out[name].append(own[o[:left]].view(np.int64))
        return pa.table({
            "sig": pa.array(out["sig"], pa.binary()), "n": pa.array(out["n"], pa.int64()),
            "tokens": pa.array(out["tokens"], pa.binary()),
            **{p: pa.array(out[p], pa.list_(pa.int64())) for p in ("p0", "p1", "p2")},
        })

    return run


def _sharing(sets: DataFrame, prefix: str, keys: list[str], label: str) -> DataFrame:
    """Components of sets that share a prefix token (within the keys): a star per token, never its pairs."""
    tokens = sets.select("sig", *keys, F.explode(prefix).alias("token"))
    stars = tokens.groupBy(*keys, "token").agg(F.min("sig").alias("least"), F.count(F.lit(1)).alias("times")).where("times > 1")
    return components(tokens.join(stars, [*keys, "token"]), "sig", "least", label)


def _linked(rows: list[dict], percent: int) -> list[tuple[bytes, bytes]]:
    """Links within a block, as a spanning forest: pairs that already hang together are not compared.

    A pair is compared exactly if it shares a prefix token under every order and its sizes allow the similarity. A block of
    two different chunks looks at pairs across them only.
    """
    count = len(rows)
    sizes = np.array([r["n"] for r in rows], np.int64)
    sides = np.array([r["chunk"] for r in rows], np.int64)
    cross = bool((sides != sides[0]).any())
    sets = [np.frombuffer(r["tokens"], np.uint64) for r in rows]
    lengths = np.array([len(s) for s in sets])
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(lengths)
    holders: list[list[np.ndarray]] = []
    for p in ("p0", "p1", "p2"):
        ids = np.searchsorted(names, np.concatenate([r[p] for r in rows]).astype(np.int64).view(np.uint64))
        owner = np.repeat(np.arange(count), [len(r[p]) for r in rows])
        order = np.argsort(ids, kind="stable")
        ids, owner = ids[order], owner[order]
        cut = np.searchsorted(ids, np.arange(len(names) + 1))
        own = [np.searchsorted(names, r[p].astype(np.int64).view(np.uint64)) for r in rows]
        holders.append((owner, cut, own))
    root = np.arange(count)
    mark = np.zeros(len(names), bool)
    forest = []
    for i in range(count - 1):
        maybe = (root != root[i]) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
        maybe[: i + 1] = False
        if cross:
            maybe &= sides != sides[i]
        for owner, cut, own in holders:
            if not maybe.any():
                break
            hit = np.zeros(count, bool)
            for t in own[i]:
                hit[owner[cut[t] : cut[t + 1]]] = True
            maybe &= hit
        js = np.flatnonzero(maybe)
        if not len(js):
            continue
        mark[flat[ends[i] - lengths[i] : ends[i]]] = True
        spans = np.concatenate([np.arange(ends[j] - lengths[j], ends[j]) for j in js])
        common = np.add.reduceat(mark[flat[spans]].astype(np.int64), np.cumsum(lengths[js]) - lengths[js])
        mark[flat[ends[i] - lengths[i] : ends[i]]] = False
        for j in js[100 * common >= percent * (sizes[i] + sizes[js] - common)]:
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                forest.append((rows[i]["sig"], rows[j]["sig"]))
    return forest


def _verify(percent: int):
    """Blocks, sorted by their key -> links."""

    def links(rows: list[dict]) -> pa.RecordBatch:
        found = _linked(rows, percent) if len(rows) > 1 else []
        return pa.record_batch({
            "a": pa.array([x for x, _ in found], pa.binary()), "b": pa.array([y for _, y in found], pa.binary())
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("group", "i", "j", "chunk", "sig", "n", "tokens")}
            arrays = {p: [x.values.to_numpy() if x.values is not None else np.zeros(0, np.int64) for x in batch.column(p)]
                      for p in ("p0", "p1", "p2")}
            for k in range(batch.num_rows):
                at = (columns["group"][k], columns["i"][k], columns["j"][k])
                if at != key:
                    if len(rows) > 1:
                        yield links(rows)
                    key, rows = at, []
                rows.append({c: columns[c][k] for c in ("chunk", "sig", "n", "tokens")} | {p: arrays[p][k] for p in arrays})
        if len(rows) > 1:
            yield links(rows)

    return run


def jaccard_components(
    docs: DataFrame, words: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents link when their shingle sets have 100 * intersection >= percent * union; component_id is the smallest
    doc_id that is reachable by links. All links between different sets count, no pair of them is dropped; links
    are returned only through their components.

    1. Equal sets become one class (per chunk at once, overall by their 128-bit signature).
    2. An inverted index, hash-partitioned by token, gives every token's document frequency. Tokens of one
       document only need not be looked at again: they head every order.
    3. Sets that link share a token of their prefixes (n - least overlap + 1 tokens) under *any* order that is the same for
       all. Three are used: by frequency, and two by independent hashes. Components of prefix sharing under the first order
       bound where links can be; a component above the block size is cut further by the components under the other orders.
    4. What is still above the block size is dealt in pairs of chunks. In each block pairs must share prefix tokens under all
       orders, and are then verified by their exact overlap. A block returns a spanning forest of its links, so no step
       emits a group's pairs.
    5. Union-find over the forests.

    Shingles are compared by 54 or more bits of a 64-bit hash. Null text counts as empty; an empty set links with nothing.
    Repeated rows are members of one class. Null ids count for nothing in the smallest id. Other columns are ignored.
    """
    spark = docs.sparkSession
    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    buckets = 1 << max(6, (input_bytes(docs) // BUCKET_BYTES).bit_length())
    pieces = stored(
        wanted.mapInArrow(_index(words, buckets), _INDEX).groupBy("bucket")
        .applyInArrow(_shared, "src long, tokens binary, ids array<long>, head binary"),
        "jaccard-index",
    )
    members = stored(
        pieces.where("head is not null").select("ids", "head").mapInArrow(_members, "doc_id long, n long, sig binary"),
        "jaccard-members",
    )
    array = "p0 array<long>, p1 array<long>, p2 array<long>"
    sets = stored(
        pieces.select("src", "tokens", "head").groupBy("src")
        .applyInArrow(_classes(percent), f"sig binary, n long, tokens binary, {array}").dropDuplicates(["sig"]),
        "jaccard-sets",
    )
    labels = _sharing(sets, "p0", [], "jaccard-order0").select(F.col("node").alias("sig"), F.col("root").alias("group"))
    grouped = stored(sets.join(labels, "sig"), "jaccard-groups0")
    weight = F.sum(F.length("tokens") / 8 + 1)
    for k in (1, 2):
        large = grouped.groupBy("group").agg(weight.alias("w")).where(F.col("w") > BLOCK_TOKENS).select("group")
        if large.isEmpty():
            break
        finer = _sharing(grouped.join(large, "group", "left_semi"), f"p{k}", ["group"], f"jaccard-order{k}")
        finer = finer.select(F.col("node").alias("sig"), F.col("root").alias("finer"))
        grouped = stored(
            grouped.join(large.withColumn("big", F.lit(True)), "group", "left").join(finer, "sig", "left")
            # A set of a large group that shares nothing under this order is alone.
            .withColumn("group", F.when(F.col("big"), F.coalesce("finer", "sig")).otherwise(F.col("group")))
            .drop("big", "finer"),
            f"jaccard-groups{k}",
        )
    chunks = grouped.groupBy("group").agg(F.ceil(weight / BLOCK_TOKENS).cast("int").alias("chunks"), F.count(F.lit(1)).alias("m"))
    blocks = (
        grouped.join(chunks.where("m > 1").drop("m"), "group")
        .withColumn("chunk", F.pmod(F.xxhash64("sig"), "chunks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("group", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "sig", "n",
                "tokens", "p0", "p1", "p2")
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    links = (
        blocks.repartition(parts, "group", "i", "j").sortWithinPartitions("group", "i", "j")
        .mapInArrow(_verify(percent), "a binary, b binary")
    )
    joined = components(links, "a", "b", "jaccard-links").select(F.col("node").alias("sig"), "root")
    classes = members.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("least")).join(joined, "sig", "left")
    classes = classes.withColumn("root", F.coalesce("root", "sig"))
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(classes.join(smallest, "root").select("sig", "component_id"), "jaccard-classes")
    return members.join(named, "sig", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_per_component(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the smallest id of their component, all columns as they are.

    Documents without words link with nothing and stay, and so do rows with a null id whose component has no other id. Rows that
    repeat a kept id with the same text are one document and stay once.
    """
    kept = (
        jaccard_components(docs, words, percent, id_col, text_col)
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("doc_id").agg(F.count(F.lit(1)).alias("times"))
    )
    kept = stored(kept.select(F.col("doc_id").alias("__kept"), F.col("times").alias("__times")), "jaccard-kept")
    rows = docs.join(kept.hint("merge"), F.col(id_col).cast("long").eqNullSafe(F.col("__kept")))
    once = rows.where("__times = 1").select(*docs.columns)
    if kept.where("__times > 1").isEmpty():
        return once
    return once.unionByName(rows.where("__times > 1").select(*docs.columns).dropDuplicates([id_col, text_col]))

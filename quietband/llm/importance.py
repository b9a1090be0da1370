"""Target-distribution importance resampling over hashed words, with a head-tail vocabulary."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietband.llm.common import input_bytes, stored, text_or_empty

#: Bounds of the broadcast vocabularies: entries, and bytes of an entry. They only save time.
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 50_000, 20_000, 40
#: Bytes of words counted together, and the share of them from which a word of such a slice is a candidate for the head.
SLICE, HEAD_SHARE = 4 << 20, 1 / 65_536
#: Input bytes of a task that numbers drawn documents.
RANK_BYTES = 128 << 20

#: Bytes of words as they are (capital letters in lower case), all others a blank.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of bounded size."""
    plain, at = text.translate(_WORDS), 0
    while at < len(plain):
        end = plain.find(b" ", at + SLICE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def pairs_of(parts: Iterator[list[bytes]]) -> Iterator[tuple[list[bytes], list[tuple[bytes, bytes]]]]:
    """Each list of words with the pairs of neighbours that end in it."""
    last: list[bytes] = []
    for words in parts:
        yield words, list(zip([*last, *words], [*last, *words][1:]))
        last = words[-1:] or last


class HashedFeatures:
    """Buckets of words and of runs of up to two words: CRC-32 of the UTF-8 bytes, modulo `buckets`.

    Frequent words have their CRC state, and frequent pairs their bucket, in the head; all others are computed.
    """

    def __init__(self, buckets: int, longest: int, states: dict[bytes, int], pairs: dict[tuple[bytes, bytes], int]):
        self.buckets, self.longest, self.states, self.pairs = buckets, longest, states, pairs

    def _state(self, word: bytes) -> int:
        known = self.states.get(word)
        return zlib.crc32(word) if known is None else known

    def _pair(self, pair: tuple[bytes, bytes]) -> int:
        known = self.pairs.get(pair)
        # A CRC goes on from the state of the first word.
        return zlib.crc32(b" " + pair[1], self._state(pair[0])) % self.buckets if known is None else known

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """Features of all texts by bucket."""
        found, pairs = Counter(), Counter()
        for text in texts:
            if self.longest == 1:
                for words in words_of(text):
                    found.update(words)
            else:
                for words, both in pairs_of(words_of(text)):
                    found.update(words)
                    pairs.update(both)
        at = [self._state(w) % self.buckets for w in found] + [self._pair(p) for p in pairs]
        n = np.fromiter((*found.values(), *pairs.values()), np.int64, len(at))
        return np.bincount(np.array(at, np.int64), n, self.buckets).astype(np.int64)

    def weigh(self, text: bytes, gains: np.ndarray) -> tuple[int, int, int]:
        """Number of words, number of features, and sum of the features' gains."""
        n_words = n_features = weight = 0
        for words, both in ((w, []) for w in words_of(text)) if self.longest == 1 else pairs_of(words_of(text)):
            at = [self._state(w) % self.buckets for w in words] + [self._pair(p) for p in both]
            n_words, n_features = n_words + len(words), n_features + len(at)
            weight += int(gains[at].sum()) if at else 0
        return n_words, n_features, weight


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[list[bytes]]:
    held, size = [], 0
    for batch in batches:
        for text in batch.column(column):
            held.append(text.as_py() or b"")
            size += len(held[-1])
            if size >= SLICE:
                yield held
                held, size = [], 0
    if held:
        yield held


def head_vocabulary(texts: DataFrame, buckets: int, longest: int = 1) -> HashedFeatures:
    """The most frequent words with their CRC states and, for `longest` 2, the most frequent pairs with their buckets.

    Candidates are what makes up HEAD_SHARE of a slice of text or more; their counts are added up by Spark, and the first
    HEAD_WORDS and HEAD_PAIRS by count come to the driver. Entries hold at most HEAD_BYTES bytes, which bounds what is sent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, "text"):
            found: Counter = Counter()
            for text in part:
                for words, both in pairs_of(words_of(text)) if longest > 1 else ((w, []) for w in words_of(text)):
                    found.update(words)
                    found.update(map(b" ".join, both))
            least = max(2, HEAD_SHARE * sum(found.values()))
            common = [(w, n) for w, n in found.items() if n >= least and len(w) <= HEAD_BYTES]
            yield pa.record_batch({
                "entry": pa.array([w for w, _ in common], pa.binary()), "n": pa.array([n for _, n in common], pa.int64()),
            })

    counted = texts.mapInArrow(run, "entry binary, n long").groupBy("entry").agg(F.sum("n").alias("n"))
    counted = counted.withColumn("pair", F.locate(" ", F.col("entry").cast("string")) > 0)
    states, pairs = {}, {}
    for wanted, bound in ((False, HEAD_WORDS), (True, HEAD_PAIRS))[:longest]:
        for r in counted.where(F.col("pair") == wanted).orderBy(F.desc("n"), "entry").limit(bound).select("entry").collect():
            entry, crc = bytes(r.entry), zlib.crc32(bytes(r.entry))
            if wanted:
                pairs[tuple(entry.split(b" "))] = crc % buckets
            else:
                states[entry] = crc
    return HashedFeatures(buckets, longest, states, pairs)


def bucket_totals(texts: DataFrame, features: Broadcast) -> dict[int, int]:
    """Features of all texts by bucket that has any; a task returns one row per bucket that it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in _slices(batches, "text"):
            here = features.value.counts(part)
            total = here if total is None else total + here
        if total is not None:
            met = np.flatnonzero(total)
            yield pa.record_batch({"bucket": pa.array(met, pa.int32()), "n": pa.array(total[met], pa.int64())})

    rows = texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    return {r.bucket: r.n for r in rows.collect()}


def bucket_gains(source: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))) of each bucket, in doubles."""
    s_all, t_all = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array([
        math.floor(1000 * math.log((target.get(b, 0) + 1.0) * s_all / ((source.get(b, 0) + 1.0) * t_all))) for b in range(buckets)
    ], np.int64)


def noise(seed: str, doc_id) -> int:
    """floor(-1000 * ln(-ln((h + 0.5) / 2^32))), h being the first 32 bits of SHA-256 of `<seed>:<doc_id>` (null: nothing)."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _ranked(rows: DataFrame, percent: int) -> DataFrame:
    """The rows with `rank`: 1, 2, ... of the highest scores (ties to the smaller id), percent of all; null for the others.

    Rows are range-sorted by score, id and row number, so that ties of any size spread over tasks; a row's rank is its place in
    its range and the sizes of the ranges before.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    parts = max(1, -(-input_bytes(rows) // RANK_BYTES))
    placed = stored(
        rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()),
        "importance-places",
    )
    part, at = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted((r.part, r["count"]) for r in placed.groupBy(part.alias("part")).count().collect())
    offsets, before = [], 0
    for p, n in sizes:
        offsets.append((p, before))
        before += n
    table = rows.sparkSession.createDataFrame(offsets, "part long, before long")
    # One row per range of RANK_BYTES.
    placed = placed.withColumn("part", part).join(F.broadcast(table), "part")
    rank = F.col("before") + at + 1
    return placed.withColumn("rank", F.when(rank <= before * percent // 100, rank))


def importance_resample(
    docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20,
    seed: str = "2024", id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null if not drawn).

    Features are the runs of 1 to `longest` (1 or 2) words, repeats counted, in hashed buckets. A document's weight is the sum of
    its features' gains, the log ratio of the target texts' and the documents' smoothed shares of their buckets; a noise of its id
    is added (Gumbel's), and of the documents with `least_words` words or more the highest `percent` per cent are drawn: sampling
    without replacement in proportion to exp(weight / 1000).

    Bucket totals cover all documents and all target texts. Null texts have no words, no features and weight 0. A null id counts
    as an empty text in the noise and comes last among equal scores. Repeated rows count and are drawn each. An empty
    table gives an empty result; without target texts all t are 0. Other columns have no effect.
    """
    texts, wanted = (x.select(text_or_empty(text_col).cast("binary").alias("text")) for x in (docs, target))
    context = docs.sparkSession.sparkContext
    features = context.broadcast(head_vocabulary(texts, buckets, longest))
    gains = bucket_gains(bucket_totals(texts, features), bucket_totals(wanted, features), buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = [features.value.weigh(t.as_py(), gains) for t in batch.column(1)]
            columns = [pa.array(c, pa.int64()) for c in zip(*found)] or [pa.array([], pa.int64())] * 3
            score = pa.array([f[2] + noise(seed, i) for i, f in zip(ids, found)], pa.int64())
            yield pa.record_batch(
                [batch.column(0), *columns, score], names=["doc_id", "n_words", "n_features", "weight", "score"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    scored = stored(
        docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"))
        .mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long, score long")
        .withColumn("row", F.monotonically_increasing_id()),
        "importance-scores",
    )
    enough = F.col("n_words") >= least_words
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return _ranked(scored.where(enough), percent).select(*columns).unionByName(
        scored.where(~enough).withColumn("rank", F.lit(None).cast("long")).select(*columns)
    )

"""Packing of documents into token sequences along a space-filling curve."""

from __future__ import annotations

import gc
import os
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietband.llm.common import stored, text_or_empty, text_slices

#: Bins of the hashed document vector, dimensions that it is projected to, and bits of each.
BINS, DIMENSIONS, BITS = 256, 3, 16
#: Bounds of the memory that remembered words take: entries, and characters of one; some 50 MB for each of the two memories.
KNOWN_WORDS, KNOWN_CHARS = 300_000, 48
#: Bytes of text that are split into words at once.
SLICE = 1 << 20
#: Words that go to the library at once, and the mark of a word's last token.
RUN, WORD_END = 64, "</w>"
#: Signs that may follow a word; the vocabulary splits a run of them off.
SIGNS = ".,;:!?*&%$#|"


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """The index along the Hilbert curve of points with integer coordinates below 2**bits, one point per row.

    Coordinates are first rotated and reflected from the top bit down, then Gray-decoded, then their bits are interleaved.
    """
    x = [points[:, k].astype(np.int64) for k in range(points.shape[1])]
    for top in range(bits - 1, 0, -1):
        low = (1 << top) - 1
        for k in range(len(x)):
            set_ = (x[k] >> top) & 1 == 1
            swap = np.where(set_, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            if k:
                x[k] = x[k] ^ swap
    for k in range(1, len(x)):
        x[k] = x[k] ^ x[k - 1]
    flip = np.zeros_like(x[0])
    for top in range(bits - 1, 0, -1):
        flip = np.where((x[-1] >> top) & 1 == 1, flip ^ ((1 << top) - 1), flip)
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for k in range(len(x)):
            key = (key << 1) | (((x[k] ^ flip) >> bit) & 1)
    return key


def document_points(ids: list[np.ndarray]) -> np.ndarray:
    """Hashed token counts of each document, scaled to length one, projected to few dimensions and cut into 2**BITS steps."""
    rows = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
    flat = np.concatenate(ids).astype(np.uint64)
    bins = (((flat + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.int64) % BINS
    vectors = np.bincount(rows * BINS + bins, minlength=len(ids) * BINS).reshape(len(ids), BINS).astype(np.float64)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    directions = np.random.RandomState(1).standard_normal((BINS, DIMENSIONS))
    steps = 1 << BITS
    return np.clip((vectors @ directions + 4) / 8 * steps, 0, steps - 1).astype(np.int64)


def _is_letters(word: str) -> bool:
    """Whether a word is letters only, also once composed and lower-cased: that turns some letters into a letter and a mark."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


class WordIds:
    """Token ids of whole texts by the tokenizers library, word by word.

    The vocabulary drops white space and never merges across it, nor across the border of letters and signs, so the ids of a
    text are those of its words and signs. What was seen before is looked up, in memories of bounded size that only save time.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        tokens = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(tokens.values()) + 1, bool)
        self.ends[[i for t, i in tokens.items() if t.endswith(WORD_END)]] = True
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    @staticmethod
    def split(word: str) -> tuple[str, ...]:
        """Letters and the signs after them, or the word as it is; ASCII letters in the lower case that the vocabulary uses."""
        head = word.rstrip(SIGNS)
        if not _is_letters(head):
            return (word,)
        plain = head.lower() if head.isascii() else head
        return (plain,) if len(head) == len(word) else (plain, word[len(head) :])

    def _ids(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each piece with its ids; words of letters go to the library in runs, where each ends with its own word-end token."""
        letters = [_is_letters(p) for p in pieces]
        plain = [p for p, x in zip(pieces, letters) if x]
        runs = [" ".join(plain[i : i + RUN]) for i in range(0, len(plain), RUN)]
        found = self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, self.kind) for e in found]) if found else np.zeros(0, self.kind)
        ends = ((np.flatnonzero(self.ends[ids]) + 1) * self.kind.itemsize).tolist()
        data = ids.tobytes()
        yield from zip(plain, map(lambda a, b: data[a:b], [0, *ends], ends), strict=True)
        other = [p for p, x in zip(pieces, letters) if not x]
        for p, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            yield p, np.array(e.ids, self.kind).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [t.replace("\n", " ").split(" ") for t in texts]
        every = set().union(*words)
        new = every.difference(self.words)
        if len(self.words) + len(new) > KNOWN_WORDS:
            # What these texts hold too is kept: words that are used often stay known.
            self.words = {w: self.words[w] for w in every.difference(new)}
        # Most words are plain letters.
        plain = {w: w.lower() for w in new if w.isascii() and w.isalpha()}
        split = {w: self.split(w) for w in new.difference(plain)}
        used = set(plain.values()).union(chain.from_iterable(split.values()))
        unknown = used.difference(self.pieces)
        if len(self.pieces) + len(unknown) > KNOWN_WORDS:
            self.pieces = {p: self.pieces[p] for p in used.difference(unknown)}
        pieces = self.pieces
        pieces.update(self._ids(list(unknown)))
        self.words.update((w, pieces[p]) for w, p in plain.items())
        self.words.update((w, b"".join([pieces[p] for p in parts])) for w, parts in split.items())
        out = [b"".join(map(self.words.__getitem__, parts)) for parts in words]
        for known, fresh in ((self.words, new), (pieces, unknown)):
            for w in fresh:
                if len(w) > KNOWN_CHARS:
                    del known[w]
        return out


def _tokens(path: str, end_id: int):
    """documents -> doc_id, key along the curve, number of ids, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pack = WordIds(path), zstandard.ZstdCompressor(level=1)
        end = np.array([end_id], words.kind).tobytes()
        # What is remembered holds no cycles, and looking for them takes a fifth of the time.
        gc.disable()
        try:
            for batch in batches:
                for lo, hi in text_slices(batch.column(1), SLICE):
                    ids = [x + end for x in words.encode([t or "" for t in batch.column(1)[lo:hi].to_pylist()])]
                    arrays = [np.frombuffer(x, words.kind) for x in ids]
                    yield pa.record_batch({
                        "doc_id": batch.column(0)[lo:hi],
                        "curve": pa.array(hilbert_keys(document_points(arrays), BITS), pa.int64()),
                        "n": pa.array([len(a) for a in arrays], pa.int64()),
                        "width": pa.array([words.kind.itemsize] * len(arrays), pa.int32()),
                        "ids": pa.array([pack.compress(x) for x in ids], pa.binary()),
                    })
        finally:
            gc.enable()

    return run


_PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack(size: int):
    """Documents in order -> pieces that fill sequences of `size` ids; what is left over fills sequences of powers of two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        sequence = TaskContext.get().partitionId() << 40
        # Pieces of the open sequence: (doc_id, start, ids, ids of the document).
        held: list[tuple] = []
        room = size
        out: list[tuple] = []

        def close() -> None:
            nonlocal held, room, sequence
            offset = 0
            for doc, start, ids, total in held:
                out.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset))
                offset += len(ids)
            sequence += 1
            held, room = [], size

        def flush() -> pa.RecordBatch:
            nonlocal out
            columns = list(zip(*out))
            out = []
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
            return pa.record_batch({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

        for batch in batches:
            for doc, width, blob in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "width", "ids"))):
                ids = np.frombuffer(unpack.decompress(blob), f"<u{width}")
                at = 0
                while at < len(ids):
                    take = min(room, len(ids) - at)
                    held.append((doc, at, ids[at : at + take], len(ids)))
                    at, room = at + take, room - take
                    if not room:
                        close()
                if len(out) >= 10_000:
                    yield flush()
        rest, left = held, size - room
        held = []
        while rest:
            room = cut = 1 << (left.bit_length() - 1)
            while room:
                doc, start, ids, total = rest.pop(0)
                take = min(room, len(ids))
                held.append((doc, start, ids[:take], total))
                if take < len(ids):
                    rest.insert(0, (doc, start + take, ids[take:], total))
                room -= take
            close()
            left -= cut
        if out:
            yield flush()

    return run


def pack_along_curve(
    docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document becomes its token ids (tokenizer: path of a tokenizers file) and `end_id`. A hashed vector of its ids, projected
    to a few dimensions, has a place on a Hilbert curve; documents are range-sorted along it, so neighbours in a sequence are
    alike, and cut freely into sequences of `size` ids. Only the last ids of each range do not fill a sequence; they go to
    sequences whose lengths are powers of two, which need no padding.

    Ties along the curve (copies of one text, say) are ordered, and split over ranges, by doc_id. Null text counts as empty and
    has `end_id` as its only id. Null ids and repeated rows are packed like others. An empty table gives an empty result. Ids are
    computed once and written to the shared folder before the sort.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    tokens = stored(
        rows.mapInArrow(_tokens(tokenizer, end_id), "doc_id long, curve long, n long, width int, ids binary"), "pack-tokens"
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        tokens.repartitionByRange(parts, "curve", "doc_id").sortWithinPartitions("curve", "doc_id")
        .mapInArrow(_pack(size), f"doc_id long, {_PIECES}")
    )

"""Exact token counts at every prefix of a text, by dynamic programming over prefixes."""

from __future__ import annotations

import gc
import json
import os
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietband.llm.bpe import byte_characters
from quietband.llm.common import text_or_empty, text_slices

#: Bounds of the memories that only save time: words, characters of a word, pairs of tokens, runs of combining characters.
KNOWN_WORDS, KNOWN_CHARS, KNOWN_PAIRS, KNOWN_CLUSTERS = 500_000, 48, 1 << 18, 50_000
#: Slots for pairs that numpy looks up; a power of two.
PAIR_SLOTS = 1 << 20
#: Bytes of text handled together.
SLICE = 1 << 20
LETTER, DIGIT, OTHER, WHITE = range(4)
#: Signs that may follow a word; a run of them is one piece.
SIGNS = ".,;:!?*&%$#"


@lru_cache(maxsize=1)
def _second_characters() -> frozenset[str]:
    """Characters that composition may join with the one before, apart from those with a combining class."""
    pairs = (unicodedata.decomposition(chr(c)).split() for c in range(sys.maxunicode + 1))
    found = {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<")}
    return frozenset(found | {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))})


class Prefixes:
    """Counts of one piece at each of its prefixes; `add` goes on where the last call ended.

    The last token of an encoded prefix is the only token that ends there and fits the last token of the prefix before it, so
    count[e] = count[e - its length] + 1. There are two tables: for a piece that goes on, and for one that ends there.
    """

    __slots__ = ("bpe", "count", "data", "ended", "kind", "last")

    def __init__(self, bpe: PrefixBpe, kind: int):
        self.bpe, self.kind, self.data = bpe, kind, bytearray()
        self.last, self.count, self.ended = [-1], [0], [0]

    def add(self, more: bytes) -> None:
        bpe, data, last, count, ended = self.bpe, self.data, self.last, self.count, self.ended
        step, inner, final, pairs, base = bpe.step, bpe.inner, bpe.final, bpe.pairs, bpe.base
        done = len(data)
        data += more
        for end in range(done + 1, len(data) + 1):
            # Backwards through the tokens that end here, until no token ends in the bytes walked.
            start, node, token, known = end, 0, -1, -1
            while start and (token < 0 or known < 0):
                start -= 1
                node = step.get(node << 8 | data[start])
                if node is None:
                    break
                before = last[start]
                if known < 0 and final[node] >= 0:
                    fits = pairs.get(before * base + final[node])
                    if bpe.fits(before, final[node]) if fits is None else fits:
                        known = count[start] + 1
                if token < 0 and inner[node] >= 0:
                    fits = pairs.get(before * base + inner[node])
                    if bpe.fits(before, inner[node]) if fits is None else fits:
                        token, tokens = inner[node], count[start] + 1
            ended.append(known)
            last.append(token)
            count.append(tokens)

    def cut(self, size: int) -> None:
        """Forget all but the first `size` bytes."""
        del self.data[size:]
        for table in (self.last, self.count, self.ended):
            del table[size + 1 :]


class PrefixBpe:
    """A BPE vocabulary with word ends that counts the tokens of every prefix."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        library = Tokenizer.from_file(path)
        self.normalize, self.pieces = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        names, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        number = {c: b for b, c in enumerate(byte_characters())}
        self.base = max(names.values()) + 1
        #: Per token: the rank of the merge that makes it (single bytes: -1), and that merge's parts.
        self.rank, self.left, self.right = [-1] * self.base, [-1] * self.base, [-1] * self.base
        self.pair_rank: dict[int, int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            token, a, b = names[a + b], names[a], names[b]
            self.pair_rank[a * self.base + b] = rank
            self.rank[token], self.left[token], self.right[token] = rank, a, b
        #: A trie of the tokens' bytes from the last to the first; per node the token that goes on and the one that ends a word.
        self.step: dict[int, int] = {}
        self.inner, self.final = [-1], [-1]
        for name, token in names.items():
            ends = name.endswith(suffix) and len(name) > len(suffix)
            content = name[: -len(suffix)] if ends else name
            # Tokens that no merge makes, of more than one byte, are never part of an encoding.
            if all(c in number for c in content) and (self.rank[token] >= 0 or len(content) == 1):
                node = 0
                for c in reversed(content):
                    node = self.step.setdefault(node << 8 | number[c], len(self.inner))
                    if node == len(self.inner):
                        self.inner.append(-1)
                        self.final.append(-1)
                (self.final if ends else self.inner)[node] = token
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        keys = sorted(self.step)
        self.step_keys, self.step_nodes = np.array(keys), np.array([self.step[k] for k in keys])
        self.token_arrays = np.array([self.inner, self.final])
        self.slot_keys, self.slot_fits = np.full(PAIR_SLOTS, -(1 << 62)), np.zeros(PAIR_SLOTS, bool)
        self.whole = {t: self._comes_whole(t) for t in (*self.inner, *self.final) if t >= 0}
        #: What is known of pairs of tokens, by the first (-1: none) and the second.
        self.pairs: dict[int, bool] = {}
        #: Letters that are one letter after normalisation, whatever stands around them.
        self.plain: set[str] = set()
        self.kinds: dict[str, int] = {}
        self.clusters: dict[str, str] = {}
        self.words: dict[str, bytes] = {}

    def _crossed(self, a: int, b: int, until: int = 1 << 62) -> bool:
        """Whether a merge of a rank below `until` joins the end of token a with the start of token b, or parts of them.

        Merges happen in the order of their ranks. Going back in time, the younger of the two tokens at the border is taken
        apart; equal ones were made from the left, so the right one is younger. A pair merged unless a neighbour came first.
        """
        rank, pair_rank, base = self.rank, self.pair_rank, self.base
        left_until, right_until = until, until - 1
        while True:
            merge = pair_rank.get(a * base + b)
            if merge is not None and merge < left_until and merge <= right_until:
                return True
            if rank[a] < 0 and rank[b] < 0:
                return False
            if rank[a] > rank[b]:
                left_until, a = rank[a], self.right[a]
            else:
                right_until, b = rank[b], self.left[b]

    def _comes_whole(self, token: int) -> bool:
        """Whether the encoding of a token's bytes is that token: no border inside it is crossed by an earlier merge."""
        todo = [token]
        while todo:
            token = todo.pop()
            if self.rank[token] >= 0:
                a, b = self.left[token], self.right[token]
                if self._crossed(a, b, self.rank[token]):
                    return False
                todo += [a, b]
        return True

    def fits(self, before: int, token: int) -> bool:
        """Whether `token` may follow `before` (-1: nothing) in an encoding."""
        key = before * self.base + token
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KNOWN_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.whole[token] and (before < 0 or not self._crossed(before, token))
        return known

    def kind(self, c: str) -> int:
        """Class of a normalised character, as the library's own pre-tokenizer splits it."""
        known = self.kinds.get(c)
        if known is None:
            around = len(self.pieces(f"a{c}a"))
            if around == 1:
                known = LETTER
            elif around == 2:
                known = WHITE
            else:
                known = OTHER if len(self.pieces(c + c)) == 1 else DIGIT
            self.kinds[c] = known
        return known

    def changes(self, texts: list[str]) -> list[np.ndarray]:
        """Change of the token count at each code point of each text.

        Words (between blanks and newlines) do not depend on each other; `words` holds, per word, the changes at its code points
        and at the blank after it, as 16-bit integers.
        """
        split = [t.replace("\n", " ").split(" ") for t in texts]
        new = set().union(*split) - self.words.keys()
        if len(self.words) + len(new) > KNOWN_WORDS:
            self.words.clear()
            new = set().union(*split)
        self._learn(new)
        out = [np.frombuffer(b"".join([self.words[w] for w in own]), "<i2")[:-1] for own in split]
        for w in new:
            if len(w) > KNOWN_CHARS:
                del self.words[w]
        return out

    def _learn(self, words: set[str]) -> None:
        """Plain words are counted together, all others one by one."""
        plain, heads, tails = [], [], []
        for word in words:
            head = word.rstrip(SIGNS)
            if (
                len(head) <= KNOWN_CHARS and head.isalpha()
                and (head.isascii() or unicodedata.is_normalized("NFC", head) and (self.plain.issuperset(head) or all(map(self._is_plain, head))))
            ):
                plain.append(word)
                heads.append(head)
                tails.append(word[len(head) :])
            else:
                self.words[word] = _packed(self._anything(word))
        signs = {t: _packed(self._anything(t)) for t in set(tails)}
        if heads:
            # Each letter alone: a sigma has no final form.
            packed, ends = self._heads("\n".join(heads).replace("Σ", "σ").lower().encode().split(b"\n"))
            # The changes of a piece after another one are those of the piece alone.
            self.words.update(
                (word, packed[start:end] + signs[tail]) for word, tail, start, end in zip(plain, tails, [0, *ends], ends)
            )

    def _heads(self, pieces: list[bytes]) -> tuple[bytes, list[int]]:
        """Changes at the code points of each piece, one after the other, and where each piece's end."""
        data, lengths = np.frombuffer(b"".join(pieces), np.uint8), np.array([len(p) for p in pieces])
        ends = np.cumsum(lengths)
        at = np.arange(len(data)) - np.repeat(ends - lengths, lengths)
        counts = self._ended(data, at)
        # Only the last byte of a code point ends a prefix.
        whole = np.append(data[1:] & 0xC0 != 0x80, True)
        first = at == 0
        before = np.where(np.cumsum(first)[whole] != np.concatenate([[0], np.cumsum(first)[whole][:-1]]), 0,
                          np.concatenate([[0], counts[whole][:-1]]))
        packed = (counts[whole] - before).astype("<i2").tobytes()
        return packed, (np.cumsum(whole)[ends - 1] * 2).tolist()

    def _ended(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """What Prefixes counts, for many pieces at once: tokens if the piece ended at each byte; at: a byte's place in its piece.

        First the tokens that end at each byte are found, by length. Then the pieces are walked side by side, byte after byte;
        of the tokens that end at one byte exactly one fits, in either table.
        """
        found = []
        active, node = np.arange(len(data)), np.zeros(len(data), np.int64)
        size = 0
        while len(active):
            size += 1
            key = node << 8 | data[active - size + 1]
            place = np.minimum(np.searchsorted(self.step_keys, key), len(self.step_keys) - 1)
            known = self.step_keys[place] == key
            active, node = active[known], self.step_nodes[place[known]]
            # By place in the piece, so that each step of the walk takes a slice.
            order = np.argsort(at[active], kind="stable")
            ends = active[order]
            found.append((ends, self.token_arrays[:, node[order]], np.searchsorted(at[ends], np.arange(at.max() + 2))))
            longer = at[active] >= size
            active, node = active[longer], node[longer]
        last, count = np.full(len(data), -1), np.zeros(len(data), np.int64)
        ended = np.zeros(len(data), np.int64)
        for step in range(at.max() + 1):
            for size, (ends, tokens, starts) in enumerate(found[: step + 1], 1):
                part = slice(starts[step], starts[step + 1])
                here = ends[part]
                if not len(here):
                    break
                before, so_far = (last[here - size], count[here - size]) if size <= step else (np.full(len(here), -1), np.zeros(len(here), np.int64))
                for kind, of in enumerate(tokens[:, part]):
                    open_ = np.flatnonzero((of >= 0) & ((last[here] < 0) if kind == 0 else (ended[here] == 0)))
                    open_ = open_[self._fit(before[open_], of[open_])]
                    if kind == 0:
                        last[here[open_]], count[here[open_]] = of[open_], so_far[open_] + 1
                    else:
                        ended[here[open_]] = so_far[open_] + 1
        return ended

    def _fit(self, before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """`fits` of many pairs; answers lie in a table that newer ones overwrite."""
        keys = before * self.base + tokens
        slots = (keys * 0x9E3779B1 >> 7) & (len(self.slot_keys) - 1)
        missing = self.slot_keys[slots] != keys
        out = self.slot_fits[slots]
        if missing.any():
            new, which = np.unique(keys[missing], return_inverse=True)
            first = np.full(len(new), -1)
            first[which] = before[missing]
            answers = np.array([self.fits(b, k - b * self.base) for b, k in zip(first.tolist(), new.tolist())], bool)
            out[missing] = answers[which]
            self.slot_keys[slots[missing]], self.slot_fits[slots[missing]] = keys[missing], answers[which]
        return out

    def _is_plain(self, c: str) -> bool:
        if c not in self.plain:
            if len(c.lower()) > 1 or self.normalize(c) != c.lower() or self.kind(c.lower()) != LETTER:
                return False
            self.plain.add(c)
        return True

    def _anything(self, word: str) -> list[int]:
        counts: list[int] = []
        total, at = 0, 0
        for m in self.special.finditer(word) if self.special else ():
            # Until its last character a special token is ordinary text.
            part = self._plain(word[at : m.end() - 1])
            counts += [total + n for n in part]
            before = m.start() - at
            total += (part[before - 1] if before else 0) + 1
            counts.append(total)
            at = m.end()
        return counts + [total + n for n in self._plain(word[at:])]

    def _plain(self, text: str) -> list[int]:
        """Counts at each code point of a text without special tokens.

        A code point that composes with those before it belongs to their cluster; while a cluster grows it is normalised
        again and its pieces are walked again from its start.
        """
        counts: list[int] = []
        walk, start = Walk(self), None
        cluster = ""
        for c in text:
            if not c.isascii() and (unicodedata.combining(c) or c in _second_characters()) and cluster:
                cluster += c
                walk.back(start)
            else:
                cluster, start = c, walk.mark()
            walk.feed(self._normal(cluster))
            counts.append(walk.total())
        return counts

    def _normal(self, cluster: str) -> str:
        known = self.clusters.get(cluster)
        if known is None:
            if len(self.clusters) >= KNOWN_CLUSTERS:
                self.clusters.clear()
            known = self.clusters[cluster] = self.normalize(cluster)
        return known


def _packed(counts: list[int]) -> bytes:
    """Changes at each code point and at the blank after them, as 16-bit integers."""
    return np.diff(np.array([0, *counts, counts[-1] if counts else 0])).astype("<i2").tobytes()


#: Contractions that are pieces of their own, by the letters after the apostrophe.
SHORT, SHORT_STARTS = {"s", "t", "re", "ve", "m", "ll", "d"}, {b"r", b"v", b"l"}


class Walk:
    """Pieces of a normalised text, character by character; only the last two can still change."""

    def __init__(self, bpe: PrefixBpe):
        self.bpe, self.before, self.open = bpe, 0, []

    def mark(self) -> tuple:
        return self.before, [(p, len(p.data)) for p in self.open]

    def back(self, mark: tuple) -> None:
        self.before, self.open = mark[0], [p for p, _ in mark[1]]
        for piece, size in mark[1]:
            piece.cut(size)

    def total(self) -> int:
        return self.before + sum(p.ended[-1] for p in self.open)

    def _new(self, kind: int, data: bytes) -> None:
        if len(self.open) == 2:
            self.before += self.open.pop(0).ended[-1]
        piece = Prefixes(self.bpe, kind)
        piece.add(data)
        self.open.append(piece)

    def feed(self, text: str) -> None:
        for c in text:
            kind = self.bpe.kind(c)
            last = self.open[-1] if self.open else None
            if kind == WHITE:
                self.before, self.open = self.total(), []
            elif last is None:
                self._new(kind, c.encode("utf-8"))
            elif last.data == b"'" and c in SHORT:
                self.open.pop()
                self._new(WHITE, b"'" + c.encode())  # of no class: nothing is added to it
            elif (
                len(self.open) == 2 and self.open[0].data == b"'" and bytes(last.data) in SHORT_STARTS
                and last.data.decode() + c in SHORT
            ):
                data = b"'" + last.data + c.encode()
                self.open = []
                self._new(WHITE, data)
            elif kind != DIGIT and kind == last.kind:
                last.add(c.encode("utf-8"))
            else:
                self._new(kind, c.encode("utf-8"))


@lru_cache(maxsize=1)
def _counter(path: str) -> PrefixBpe:
    return PrefixBpe(path)


def prefix_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_chars, n_tokens, changes.

    `changes` holds, for every code point, by how much the number of tokens of the text up to it differs from the number
    before it (16-bit integers, compressed): their running sum is the exact count at every prefix, as the tokenizers
    library gives it for that prefix alone, special strings included. Counts can fall as a word becomes a known one.

    Words (between blanks and newlines) are independent of each other; those seen before are looked up. Null text counts as
    empty and has no tokens. Repeated rows, null ids and other columns pass without effect; an empty table gives an empty
    result. Texts are processed whole, in time proportional to their length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, pack = _counter(vocabulary), zstandard.ZstdCompressor(level=1)
        # What is remembered holds no cycles, and looking for them takes time.
        gc.disable()
        try:
            for batch in batches:
                for lo, hi in text_slices(batch.column(1), SLICE):
                    texts = batch.column(1)[lo:hi].to_pylist()
                    changes = bpe.changes(texts)
                    yield pa.record_batch({
                        "doc_id": batch.column(0)[lo:hi],
                        "n_bytes": batch.column(2)[lo:hi],
                        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                        "n_tokens": pa.array([int(x.sum(dtype=np.int64)) for x in changes], pa.int64()),
                        "changes": pa.array([pack.compress(x.tobytes()) for x in changes], pa.binary()),
                    })
        finally:
            gc.enable()

    rows = docs.select(
        F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"),
        F.octet_length(text_or_empty(text_col)).cast("long").alias("n_bytes"),
    )
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_chars long, n_tokens long, changes binary")


def _answers(rows: DataFrame, name: str, answer, *arguments: str) -> DataFrame:
    """The rows with a long column `name`: answer(counts at 0, 1, ... code points, *values of the argument columns)."""
    kept = [c for c in rows.columns if c != name]
    out = rows.select(*kept, F.lit(None).cast("long").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            values = []
            for blob, *given in zip(*(batch.column(c).to_pylist() for c in ("changes", *arguments))):
                counts = np.concatenate([[0], np.cumsum(np.frombuffer(unpack.decompress(blob), "<i2"), dtype=np.int64)])
                values.append(answer(counts, *given))
            yield pa.record_batch([*(batch.column(c) for c in kept), pa.array(values, pa.int64())], names=[*kept, name])

    return rows.mapInArrow(run, out)


def tokens_up_to(counts: DataFrame, chars: str, name: str = "tokens") -> DataFrame:
    """Rows of prefix_counts with the number of tokens of the first `chars` (a column) code points; beyond the end: of all.

    A null or negative number gives null.
    """
    return _answers(
        counts, name, lambda c, p: None if p is None or p < 0 else int(c[min(p, len(c) - 1)]), chars
    )


def longest_prefix(counts: DataFrame, budget: int, name: str = "prefix_chars") -> DataFrame:
    """Rows of prefix_counts with the code points of the longest prefix that has at most `budget` tokens."""
    return _answers(counts, name, lambda c: int(np.flatnonzero(c <= budget)[-1]))

"""BPE encoding in batched numpy merge rounds, and decoding."""

from __future__ import annotations

import gc
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietband.llm.common import text_or_empty, text_slices

#: Bounds of the memory that remembered words take: entries, and characters of one.
KNOWN_WORDS, KNOWN_CHARS = 500_000, 48
_WHITE = r"[\t-\r \x85\xa0  -     　]"
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^ \p{L}\p{N}]+")
_NONE = np.int64(2**62)
#: Signs that may follow a word's letters; a run of them is one piece.
SIGNS = ".,;:!?*&%$#|"


def _lowered(text: str) -> str:
    """Composed and lower-cased, each character alone: no final form of sigma."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in printable}
    for n, b in enumerate(b for b in range(256) if b not in names):
        names[b] = chr(256 + n)
    return [names[b] for b in range(256)]


class WordBpe:
    """A BPE vocabulary whose words end in a suffix; lower-cases, drops white space, works on bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocabulary = spec["model"], dict(spec["model"]["vocab"])
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        suffix = model["end_of_word_suffix"]
        self.base = 1 << int(max(vocabulary.values())).bit_length()
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = np.array([vocabulary[a] * self.base + vocabulary[b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], order.astype(np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        letters = byte_characters()
        self.inner = np.array([vocabulary[c] for c in letters], np.int64)
        self.last = np.array([vocabulary[c + suffix] for c in letters], np.int64)
        self.added = added
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        size = max([*vocabulary.values(), *added.values()]) + 1
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.names = [b""] * size
        for token, i in {**vocabulary, **added}.items():
            self.names[i] = token.encode("utf-8")
        self.digits = [str(i).encode() for i in range(size)]
        self.known: dict[str, bytes] = {}
        self.merged_words: dict[str, bytes] = {}
        self.path, self.library = path, None

    def merge_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each non-empty word, by merge rounds over all of them at once.

        Symbols of all words lie in one flat array. Each round finds every pair's rank by binary search over the sorted pair
        keys, takes the lowest rank of each word, and merges its places from the left. A word without a pair is done.
        """
        out: list[np.ndarray] = [None] * len(words)
        lengths = np.array([len(w) for w in words], np.int64)
        symbols = self.inner[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(lengths)
        if len(words):
            symbols[ends - 1] = self.last[np.frombuffer(b"".join(words), np.uint8)[ends - 1]]
        names = np.arange(len(words))
        while len(names):
            starts = np.cumsum(lengths) - lengths
            keys = symbols * self.base + np.append(symbols[1:], 0)
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            ranks = np.where(self.pairs[at] == keys, self.ranks[at], _NONE)
            ranks[starts + lengths - 1] = _NONE  # a word's last symbol begins no pair
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == _NONE
            for k in np.flatnonzero(done):
                out[names[k]] = symbols[starts[k] : starts[k] + lengths[k]]
            hit = (ranks == np.repeat(lowest, lengths)) & (ranks < _NONE)
            # Of overlapping places (a run of one symbol) every other one, from the left.
            place = np.flatnonzero(hit)
            fresh = np.flatnonzero(np.diff(place, prepend=-2) > 1)
            step = np.arange(len(place)) - np.repeat(fresh, np.diff(np.append(fresh, len(place))))
            place = place[step % 2 == 0]
            symbols[place] = self.merged[ranks[place]]
            keep = np.repeat(~done, lengths)
            keep[place + 1] = False
            lengths = np.add.reduceat(keep.astype(np.int64), starts)[~done]
            symbols, names = symbols[keep], names[~done]
        return out

    def _split(self, word: str) -> list[str | int]:
        """Pieces of a text without blanks and newlines: strings to be merged, or ids of added tokens."""
        head = word.rstrip(SIGNS)
        if head.isalpha():  # most words: letters, and signs after them
            plain = head.lower() if head.isascii() else _lowered(head)
            if plain.isalpha():
                return [plain, word[len(head) :]] if len(head) < len(word) else [plain]
        pieces: list[str | int] = []
        at = 0
        for m in self.special.finditer(word) if self.special else ():
            pieces += [word[at : m.start()], self.added[m.group()]]
            at = m.end()
        out: list[str | int] = []
        for part in [*pieces, word[at:]]:
            if isinstance(part, int):
                out.append(part)
            elif part:
                if not part.isascii() and any(unicodedata.category(c) == "Cn" for c in part):
                    out += self._split_unknown(part)
                    continue
                out += _PIECES.findall(regex.sub(_WHITE, " ", _lowered(part)))
        return out

    def _split_unknown(self, part: str) -> list[str]:
        """Pieces of a text with characters that this Python's Unicode version does not know: the library's own tables decide."""
        from tokenizers import Tokenizer

        self.library = self.library or Tokenizer.from_file(self.path)
        plain = self.library.normalizer.normalize_str(part)
        number = {c: b for b, c in enumerate(byte_characters())}
        return [bytes(number[c] for c in piece).decode("utf-8") for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian integers of `kind`."""
        words = [t.replace("\n", " ").split(" ") for t in texts]
        new = list(set().union(*words) - self.known.keys())
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known.clear()
            new = list(set().union(*words))
        split = [self._split(w) for w in new]
        pieces = {p for parts in split for p in parts if isinstance(p, str)}
        unknown = list(pieces - self.merged_words.keys())
        if len(self.merged_words) + len(unknown) > KNOWN_WORDS:
            self.merged_words.clear()
            unknown = list(pieces)
        ids = self.merged_words
        ids.update((p, x.astype(self.kind).tobytes()) for p, x in zip(unknown, self.merge_words([p.encode("utf-8", "replace") for p in unknown])))
        for w, parts in zip(new, split):
            self.known[w] = b"".join(
                ids[p] if isinstance(p, str) else np.array([p], self.kind).tobytes() for p in parts
            )
        out = [b"".join([self.known[w] for w in parts]) for parts in words]
        for known, fresh in ((self.known, new), (ids, unknown)):
            for w in fresh:
                if len(w) > KNOWN_CHARS:
                    del known[w]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens of the ids with one space between, in UTF-8: the file names no decoder."""
        return b" ".join([self.names[i] for i in ids.tolist()])


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Ids are those of the tokenizers library without added special tokens; strings of special tokens in a text get their id.
    `ids_sha256` is of the decimal ids with one space between, `decoded_sha256` of the decoded text. Null text counts as empty and
    has no ids. Repeated rows, null ids and other columns pass without effect; an empty table gives an empty result. Texts are
    processed whole, in slices of bounded size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(vocabulary)
        # What is remembered holds no cycles, and looking for them takes a fifth of the time.
        gc.disable()
        try:
            for batch in batches:
                for lo, hi in text_slices(batch.column(1)):
                    ids = [np.frombuffer(x, bpe.kind) for x in bpe.encode(batch.column(1)[lo:hi].to_pylist())]
                    decimal = [hashlib.sha256(b" ".join([bpe.digits[i] for i in x.tolist()])).hexdigest() for x in ids]
                    decoded = [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids]
                    yield pa.record_batch({
                        "doc_id": batch.column(0)[lo:hi], "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                        "ids_sha256": pa.array(decimal, pa.string()), "decoded_sha256": pa.array(decoded, pa.string()),
                    })
        finally:
            gc.enable()

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Licence scans with a positional index of rare licence words."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietband.llm.common import flat_bytes, lower_ascii, runs_of, span_hashes, text_or_empty, text_slices

#: Words per template that the index holds, by highest inverse document frequency, and how many of its first key phrase at least.
INDEXED_WORDS, PHRASE_WORDS = 8, 2
#: Words around the aligned template in which its key phrases must stand.
SLACK = 24
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
# Upper case is lowered before.

# The base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Label, template, mandatory key phrases. The wording is that of the public notices.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with"
     " the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable"
     " law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or"
     " conditions of any kind either express or implied", ("apache license version 2 0", "except in compliance with the license")),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
     " license as published by the free software foundation either version 3 of the license or at your option any later version",
     ("redistribute it and or modify it under the terms of the gnu general public license", "free software foundation")),
    ("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("mit-release", "released under the mit license", ("under the mit license",)),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
     " documentation files the software to deal in the software without restriction including without limitation the rights to use"
     " copy modify merge publish distribute sublicense and or sell copies of the software",
     ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ("permission to use copy modify and or distribute this software", "with or without fee is hereby granted")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following"
     " conditions are met", ("redistribution and use in source and binary forms", "following conditions are met")),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc0", "dedicated to the public domain under cc0 1 0", ("cc0 1 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("reserved", "all rights reserved", ("all rights reserved",)),
)


def word_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and where each text's words begin among them."""
    flat, starts = flat_bytes(text)
    flat = lower_ascii(flat)
    at, to = runs_of(_WORD[flat])
    return span_hashes(flat, at, to), np.searchsorted(at, starts)


def hashed(words: list[str]) -> list[int]:
    return word_hashes(pa.array([" ".join(words)]))[0].tolist()


@dataclass
class Index:
    """Postings of each template's rarest words: word -> (template, position); all words as hashes."""

    idf: dict[int, float]
    templates: list[tuple[str, list[int], list[list[int]]]]
    postings: dict[int, list[tuple[int, int]]]
    base: list[tuple[str, list[int], int]]

    @classmethod
    def build(cls, idf: dict[int, float]) -> Index:
        templates = [(label, hashed(t.split()), [hashed(p.split()) for p in keys]) for label, t, keys in TEMPLATES]
        postings: dict[int, list[tuple[int, int]]] = {}
        for k, (_, words, keys) in enumerate(templates):
            rare = sorted(dict.fromkeys(words), key=lambda w: (-idf[w], w))[:INDEXED_WORDS]
            # With these, a place of the first key phrase has the votes that make a candidate.
            rare += sorted(dict.fromkeys(keys[0]), key=lambda w: (-idf[w], w))[:PHRASE_WORDS]
            for at, w in enumerate(words):
                if w in rare:
                    postings.setdefault(w, []).append((k, at))
        base = []
        for phrase, label in BASE:
            words = hashed(phrase.split())
            base.append((label, words, max(range(len(words)), key=lambda i: idf[words[i]])))
        return cls(idf, templates, postings, base)

    def places(self, words: np.ndarray, phrase: list[int], anchor: int, at: np.ndarray) -> np.ndarray:
        """Starts of the phrase, among places `at` of its anchor word."""
        starts = at - anchor
        starts = starts[(starts >= 0) & (starts + len(phrase) <= len(words))]
        for k, w in enumerate(phrase):
            if k != anchor:
                starts = starts[words[starts + k] == w]
        return starts

    def scan(self, words: np.ndarray, hits: np.ndarray) -> tuple:
        """(n_base, first, last, base labels, labels, score) of one text; `hits` are the places of indexed and anchor words."""
        own = words[hits]
        found = [(label, self.places(words, p, k, hits[own == p[k]])) for label, p, k in self.base]
        base = {label for label, starts in found if len(starts)}
        starts = np.concatenate([s for _, s in found])
        labels, score = set(base), float(bool(base))
        # How many of the file's indexed words put a template at each relative position.
        votes = [
            ((k << 40) + (1 << 39) - at) + places
            for w in np.unique(own).tolist() if w in self.postings
            for places in (hits[own == w],) for k, at in self.postings[w]
        ]
        keyed, counts = np.unique(np.concatenate([np.zeros(0, np.int64), *votes]), return_counts=True)
        keyed, counts = keyed[counts > 1], counts[counts > 1]
        order = np.argsort(-counts, kind="stable")
        tried: set = set()
        for key in keyed[order].tolist():
            k, start = key >> 40, (key & ((1 << 40) - 1)) - (1 << 39)
            label, template, keys = self.templates[k]
            if label in tried:
                continue
            lo, hi = max(0, start - SLACK), start + len(template) + SLACK
            window = words[lo:hi]
            if all(len(self.places(window, p, 0, np.flatnonzero(window == p[0]))) for p in keys):
                tried.add(label)
                labels.add(label)
                score = max(score, sum((Counter(template) & Counter(window.tolist())).values()) / len(template))
        return (
            len(starts), int(starts.min()) if len(starts) else None, int(starts.max()) if len(starts) else None,
            ",".join(sorted(base)), ",".join(sorted(labels)), score,
        )


def _vocabulary() -> np.ndarray:
    words = {w for _, t, keys in TEMPLATES for p in (t, *keys) for w in p.split()} | {w for p, _ in BASE for w in p.split()}
    return np.unique(np.array(hashed(sorted(words)), np.uint64))


def _members(words: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that are in the sorted vocabulary, and which they are."""
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    places = np.flatnonzero(vocabulary[at] == words)
    return places, at[places]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that have each licence word, and (under 0) documents; one row per word and batch."""
    vocabulary = _vocabulary()
    for batch in batches:
        counts = np.zeros(len(vocabulary), np.int64)
        for lo, hi in text_slices(batch.column(0)):
            words, first = word_hashes(batch.column(0)[lo:hi])
            places, which = _members(words, vocabulary)
            doc = np.searchsorted(first, places, side="right")
            pairs = np.unique(doc.astype(np.int64) * len(vocabulary) + which)
            counts += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
        yield pa.record_batch({
            "word": pa.array(np.arange(-1, len(vocabulary)), pa.int64()), "n": pa.array([batch.num_rows, *counts], pa.int64())
        })


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of 0-9, a-z and non-ASCII bytes after A-Z are lower-cased. Base phrases are found at all their places. Beyond
    them, a text looks up all its words that are in a positional index of each template's words of highest inverse document
    frequency (counted over all documents), two of its first key phrase among them; words that agree on a template's relative position make it a candidate, and its mandatory key phrases
    must stand around that place. `score` is the largest share of an accepted template's words there, 1 if a base phrase stands in the
    text, 0 without any label. Label lists are sorted and joined by commas, empty without labels.

    Null text counts as empty. Repeated rows, null ids and other columns pass without effect; an empty table gives an empty
    result. Only the frequencies of the templates' words, a fixed number, come to the driver.
    """
    texts = docs.select(text_or_empty(text_col).alias("text"))
    vocabulary = _vocabulary()
    counted = {r.word: r.n for r in texts.mapInArrow(_frequencies, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = counted.get(-1, 0)
    idf = {int(w): math.log((total + 1) / (counted.get(k, 0) + 1)) for k, w in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index.build(idf)
        wanted = np.unique(np.array([*index.postings, *[p[k] for _, p, k in index.base]], np.uint64))
        for batch in batches:
            for lo, hi in text_slices(batch.column(1)):
                words, first = word_hashes(batch.column(1)[lo:hi])
                places, _ = _members(words, wanted)
                cut = np.searchsorted(places, first)
                rows = [(0, None, None, "", "", 0.0)] * (hi - lo)
                for k in np.flatnonzero(np.diff(cut)):
                    rows[k] = index.scan(words[first[k] : first[k + 1]], places[cut[k] : cut[k + 1]] - first[k])
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
                names = ("n_base", "first_word", "last_word", "base_labels", "labels", "score")
                yield pa.record_batch(
                    {"doc_id": batch.column(0)[lo:hi], "n_words": pa.array(np.diff(first), pa.int64())}
                    | {n: pa.array(c, t) for n, c, t in zip(names, columns, kinds)}
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    )

"""Toxicity by compression distance: two zstandard dictionaries, one trained on toxic and one on ordinary text."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietband.llm.common import text_or_empty

#: Words of one window.
WINDOW = 12
#: Bytes of the dictionaries.
TOXIC_BYTES, ORDINARY_BYTES = 1500, 16384
#: Bound of the fitted sample: labelled rows of each class, and characters of a text that may be among them.
SAMPLE_TOXIC, SAMPLE_ORDINARY, SAMPLE_CHARS = 1500, 4500, 20_000
#: Longer texts that are among them all the same, and their characters at most.
SAMPLE_LONG, LONG_CHARS = 200, 200_000


def windows(text: str) -> list[bytes]:
    """Lower-cased runs of WINDOW words, from the first to the last word of the text."""
    words = text.lower().split()
    return [" ".join(words[i : i + WINDOW]).encode("utf-8", "replace") for i in range(0, len(words), WINDOW)]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; samples too few to train on serve as its content."""
    try:
        return zstandard.train_dictionary(size, samples, k=50, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b" ".join(samples)[-size:] or b" "


@lru_cache(maxsize=4)
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters.from_level(
        9, min_match=4, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    of = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    of.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=of, compression_params=settings)


@dataclass
class ToxicityModel:
    """Dictionaries and calibration; without a labelled row of either class every score is `share`."""

    ordinary: bytes = b""
    toxic: bytes = b""
    weights: list[float] = field(default_factory=list)
    share: float = 0.0

    def features(self, texts: list[str]) -> np.ndarray:
        """What the toxic dictionary saves over the ordinary one alone, window by window, summed up per text."""
        plain, with_toxic = _compressor(self.ordinary), _compressor(self.toxic + self.ordinary)
        rows = np.zeros((len(texts), 7))
        for k, text in enumerate(texts):
            parts = windows(text)
            if parts:
                saved = np.array([len(plain.compress(w)) - len(with_toxic.compress(w)) for w in parts])
                top = np.sort(saved)[::-1]
                gain = np.maximum(saved, 0)
                rows[k] = (
                    saved.mean(), (saved >= 2).mean(), (saved >= 3).mean(), min(top[0], 12), top[:3].mean(),
                    math.log1p((saved >= 3).sum()), gain.sum() / len(text) * 10,
                )
        return rows

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), self.share)
        x = self.features(texts)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights[1:]) + self.weights[0], -30, 30)))


def _calibrate(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> list[float]:
    """Weighted logistic regression by Newton steps, with a small ridge."""
    x = np.hstack([np.ones((len(x), 1)), x])
    ridge = np.diag([0.0] + [1e-2] * (x.shape[1] - 1))
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (y - p)) - ridge @ beta
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(beta)), grad)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return beta.tolist()


def _distinctive(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """The words of toxic texts that recur in them and are far rarer in ordinary text, in runs.

    Text that both classes share would only add noise to the difference of two compressed lengths.
    """
    counts = Counter(w for t in toxic for w in set(t.lower().split()))
    plain = Counter(w for t in ordinary for w in set(t.lower().split()))
    least = max(2, len(toxic) // 50)
    chosen = {w for w, n in counts.items() if n >= least and n / len(toxic) > 10 * (plain[w] + 0.5) / len(ordinary)}
    chosen = chosen or {w for w in counts if not plain[w]}
    kept = []
    for t in toxic:
        words = [w for w in t.lower().split() if w in chosen]
        kept += [f" {' '.join(words[i : i + 8])} ".encode("utf-8", "replace") for i in range(0, len(words), 8)]
    return kept


def fit(toxic: list[str], ordinary: list[str], prior: float) -> ToxicityModel:
    """Dictionaries from the first part of each class, calibration from the rest; prior: the toxic share of all labelled rows."""
    if not toxic or not ordinary:
        return ToxicityModel(share=prior)
    a, b = math.ceil(len(toxic) * 0.6), math.ceil(len(ordinary) * 0.5)
    plain = [w for t in ordinary[:b] for w in windows(t)]
    kept = _distinctive(toxic[:a], ordinary[:b])
    model = ToxicityModel(_dictionary(plain, 2 * ORDINARY_BYTES)[-ORDINARY_BYTES:], _dictionary(kept, TOXIC_BYTES))
    held = (toxic[a:] or toxic, ordinary[b:] or ordinary)
    x = np.vstack([model.features(t) for t in held])
    y = np.repeat([1.0, 0.0], [len(t) for t in held])
    w = np.repeat([prior / len(held[0]), (1 - prior) / len(held[1])], [len(t) for t in held]) * len(y)
    model.weights = _calibrate(x, y, w)
    return model


def training_model(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """A model fitted on a bounded sample of labelled rows that are not held out.

    Per class the rows whose ids hash lowest are taken, up to SAMPLE_TOXIC and SAMPLE_ORDINARY, with texts of up to SAMPLE_CHARS
    characters; of the longer ones up to LONG_CHARS the SAMPLE_LONG that hash lowest, so that both the dictionaries and the
    calibration see long texts about as often as they occur. Labels that are null, or of no document, are left out; of several labels of one id the larger counts.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out("doc_id"))
    total = {r.toxic: r.n for r in known.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = total.get(True, 0) / max(1, sum(total.values()))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [known.where(c).orderBy(*order).limit(n).select("doc_id") for c, n in
              (("toxic > 0", SAMPLE_TOXIC), ("toxic <= 0", SAMPLE_ORDINARY))]
    wanted = picked[0].withColumn("class", F.lit(1)).unionByName(picked[1].withColumn("class", F.lit(0)))
    rows = docs.select("doc_id", text_or_empty().alias("text")).where(F.length("text") <= LONG_CHARS)
    # At most SAMPLE_TOXIC + SAMPLE_ORDINARY ids.
    rows = rows.join(F.broadcast(wanted), "doc_id").dropDuplicates(["doc_id"])
    long = rows.where(F.length("text") > SAMPLE_CHARS).orderBy(*order).limit(SAMPLE_LONG)
    texts = rows.where(F.length("text") <= SAMPLE_CHARS).unionByName(long).orderBy(*order).select("text", "class").collect()
    return fit([r.text for r in texts if r["class"]], [r.text for r in texts if not r["class"]], prior)


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from 0.5).

    Every whole text is cut into windows of WINDOW words; each is compressed with the ordinary dictionary and with both; what
    the toxic one saves, over all windows, gives the calibrated score. Nothing but the text is an input. Null text counts as
    empty and an empty text has no windows, so it gets the score of a text that saves nothing. Repeated rows, null ids and other
    columns pass without effect; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.record_batch({
                    "doc_id": part.column(0), "held_out": part.column(1),
                    "score": pa.array(model.scores(part.column(2).to_pylist()), pa.float64()),
                })

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), text_or_empty(text_col).alias("text"))
    scored = rows.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all their columns, in one pass over them."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                keep = model.scores([t or "" for t in part.column(at).to_pylist()]) < 0.5
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)

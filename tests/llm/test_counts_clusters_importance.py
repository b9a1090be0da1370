"""Operators 11 to 13: against the library, plain integers and brute force, on edge rows and on given tables."""

import hashlib
import math
import os
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quietband.llm.centroids import cluster_vectors, nearest
from quietband.llm.importance import _WORDS, HashedFeatures, importance_resample
from quietband.llm.queries import QUERIES
from quietband.llm.token_counts import PrefixBpe, longest_prefix, prefix_counts, tokens_up_to
from tests.llm.conftest import ROWS, SF

WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [(r[0], r[1] or "") for r in ROWS]


@pytest.fixture(scope="module")
def bpe():
    return PrefixBpe(WORDS)


@pytest.fixture(scope="module")
def count():
    library = Tokenizer.from_file(WORDS)
    return lambda text: len(library.encode(text, add_special_tokens=False).ids)


ODD = [
    "Hello World's don't we're 're 'r 'rx they'll x'l ab'llama !'s ''s '''t a's's's 's'd'm", "<|endoftext|>a<|startoftext|",
    "abc<|endoftext|>́e", "İstanbul é é क़ ΣΑΣ 한 한", "ạ́́b q̣̇",
    "がき 12.34 3e10 foo_bar@x.com 😀😀😂😂😂😂 👨‍👩‍👧", "x y z\x85w\x1cq\x00r \t\r\n a​b", "aaaaaaaaaaaa zzzz ''''' ,,,, ....",
    "कि हिन्दी ไทยคำ", "ǅ ﬁn ＡＢＣ שׁ \U0001fae9", "́a ́", "İ'S DON'T 'ſ 'K", "", " ",
]


@pytest.mark.parametrize("text", ODD)
def test_counts_of_every_prefix(bpe, count, text):
    assert np.cumsum(bpe.changes([text])[0]).tolist() == [count(text[:k]) for k in range(1, len(text) + 1)]


def test_counts_of_random_prefixes(bpe, count):
    letters = "abcdeefghiilnorsst'' .,<|0129éÉİß̣́ᅡᆨ가학グ中ΣΣ😀‍\n\t "
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 25)))
        assert np.cumsum(bpe.changes([text])[0]).tolist() == [count(text[:k]) for k in range(1, len(text) + 1)]


def test_counts_of_one_very_long_word(bpe, count):
    text = "aab" * 20_000 + "中文" * 10_000 + "éx" * 5_000
    assert int(bpe.changes([text])[0].sum()) == count(text)


def test_token_counts(spark, edge, nothing, count):
    counts = prefix_counts(edge, WORDS)
    assert Counter((r.doc_id, r.n_bytes, r.n_chars, r.n_tokens) for r in counts.collect()) == Counter(
        (i, len(t.encode()), len(t), count(t)) for i, t in TEXTS
    )
    by_id = dict(TEXTS)
    for r in tokens_up_to(counts.withColumn("at", F.lit(9)), "at").collect():
        assert r.tokens == count(by_id[r.doc_id][:9])
    assert {r.tokens for r in tokens_up_to(counts.withColumn("at", F.lit(-1)), "at").collect()} == {None}
    for r in longest_prefix(counts, 5).collect():
        text = by_id[r.doc_id]
        assert r.prefix_chars == max(k for k in range(min(len(text), 60) + 1) if count(text[:k]) <= 5)
    assert prefix_counts(nothing, WORDS).count() == longest_prefix(prefix_counts(nothing, WORDS), 5).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are absent")
def test_token_count_query(spark, count):
    docs = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall())
    rows = QUERIES["op11_prefix_token_counts"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), count(text), count(text) > 2048)
        assert r.half_tokens == count(text[: len(text) // 2]) and count(text[: r.fitting_chars]) <= 2048
        assert r.fitting_chars == len(text) or count(text[: r.fitting_chars + 1]) > 2048


def plain_clusters(rows, clusters, rounds, size):
    """[(vec_id, cluster, distance, centroid)] by all distances, in Python integers."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes())
    centroids = [v for _, v in sorted(kept, key=name)[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        of = [k for _, k in assign()]
        for k in set(of):
            own = [v for (_, v), j in zip(kept, of) if j == k]
            centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    return [(i, k, d, centroids[k]) for (i, _), (d, k) in zip(kept, assign())]


@pytest.mark.parametrize("clusters", [1, 3, 8, 50])
def test_clusters(spark, clusters):
    rng = random.Random(clusters)
    rows = [(i, [rng.gauss(i % 4, 0.3) for _ in range(6)]) for i in range(40)]
    rows += [(0, rows[0][1]), (None, [0.5] * 6), (50, None), (51, []), (52, [0.1] * 5), (53, [math.nan] + [0.0] * 5),
             (54, [math.inf] + [0.0] * 5), (55, [None] + [0.0] * 5), (56, [-1e-9] * 6), (57, [0.5] * 6), (58, [-1000.0] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    table = table.select("*", F.lit(1).alias("cluster"), F.lit("x").alias("distance"))
    got = cluster_vectors(table, clusters=clusters, rounds=4, size=6)
    want = plain_clusters(rows, clusters, 4, 6)
    total = Counter()
    for _, k, d, _ in want:
        total[k] += d
    assert Counter(tuple(r)[:6] for r in got.collect()) == Counter(
        (i, k, d, total[k], sum(total.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, k, d, c in want
    )
    assert cluster_vectors(table.where("false"), size=6).count() == 0


def test_equal_vectors(spark):
    table = spark.range(500).select(F.col("id").alias("vec_id"), F.array(*[F.lit(0.25)] * 64).alias("embedding"))
    rows = cluster_vectors(table).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in rows} == {(0, 0, 0)} and len(rows) == 500


def test_components_too_large(spark):
    table = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="squared distances would not fit"):
        cluster_vectors(table).collect()


def test_bounds_leave_fewer_distances():
    rng = np.random.RandomState(0)
    centres = rng.randint(-4000, 4000, (16, 64))
    whole = (centres[rng.randint(0, 16, 2000)] + rng.randint(-300, 300, (2000, 64))).astype(np.int64)
    _, directions = np.linalg.eigh(np.cov(whole.T.astype(float)))
    directions = directions[:, ::-1][:, :12]
    near = whole @ directions
    rest = np.sqrt(np.maximum((whole**2).sum(1) - (near**2).sum(1), 0))
    cluster, distance, measured = nearest(whole, near, rest, centres.astype(np.int64), directions)
    every = ((whole[:, None] - centres[None]) ** 2).sum(2)
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all() and measured < 2 * len(whole)


def resampled(docs, target, longest, buckets, percent, least, seed):
    """[(doc_id, n_features, weight, score, rank)], ranks of equal (score, id) in any order."""
    word = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def features(text):
        words = word.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    own = [(i, *features(t)) for i, t in docs]
    source = Counter(b for *_, f in own for b in f)
    wanted = Counter(b for _, t in target for b in features(t)[1])
    s_all, t_all = sum(source.values()) + buckets, sum(wanted.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * s_all / ((source[b] + 1) * t_all)))
    rows = []
    for i, n, f in own:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n])
    enough = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(enough[: len(enough) * percent // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


@pytest.mark.parametrize(("longest", "percent"), [(1, 10), (1, 100), (2, 50)])
def test_importance(spark, edge, nothing, longest, percent):
    target = spark.createDataFrame([(0, "the same LONG line stands"), (1, None), (2, "Σίσυφος été 漢字")], "item_id long, text string")
    want = resampled([r[:2] for r in ROWS], [tuple(r) for r in target.collect()], longest, 1000, percent, 5, "s")
    got = importance_resample(edge, target, longest, 1000, percent, 5, "s")
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert importance_resample(nothing, target).count() == 0
    assert importance_resample(edge, nothing.select("text")).count() == len(ROWS)


@pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are absent")
def test_importance_query(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    target = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    got = sorted(map(tuple, QUERIES["op13_importance_resampling"](spark, SF).collect()))
    assert got == sorted(resampled(docs, target, 1, 10_000, 10, 20, "2024"))


def test_importance_of_many_equal_scores(spark, monkeypatch):
    """One id repeated: ranks are gapless over several ranges."""
    from quietband.llm import importance

    monkeypatch.setattr(importance, "RANK_BYTES", 2000)
    docs = spark.range(2000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one two three").alias("text")).repartition(5)
    rows = importance_resample(docs, docs.limit(1), least_words=2, percent=50).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 1001)) and len(rows) == 2000


def test_head_changes_nothing():
    """Buckets with and without frequent words and pairs known, and words that end at a slice's border."""
    text = ("Alpha beta ALPHA beta 漢字 " * 50).encode()
    plain = HashedFeatures(997, 2, {}, {})
    head = HashedFeatures(997, 2, {b"alpha": zlib.crc32(b"alpha")}, {(b"alpha", b"beta"): zlib.crc32(b"alpha beta") % 997})
    assert (plain.counts([text]) == head.counts([text])).all()
    gains = np.arange(997)
    assert plain.weigh(text, gains) == head.weigh(text, gains) == (250, 499, int((plain.counts([text]) * gains).sum()))
    assert len(_WORDS) == 256


def test_features_do_not_depend_on_slices(monkeypatch):
    from quietband.llm import importance

    text = ("one two three " * 200).encode()
    whole = HashedFeatures(97, 2, {}, {}).counts([text])
    monkeypatch.setattr(importance, "SLICE", 50)
    assert (HashedFeatures(97, 2, {}, {}).counts([text]) == whole).all()

"""The registered queries: against their SQL, or against plain versions on the smallest tables."""

import hashlib
import os
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
import regex

import corpus_pipeline
from quietband.llm import license_scan
from quietband.llm.queries import ORACLES, QUERIES
from quietband.llm.toxicity import training_model
from tests.llm import brute
from tests.llm.conftest import SF
from verification.compare import differences, open_duckdb

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are absent")
NATIVE = ("op8_minhash_line_dedup", "op9_invertible_sketch")


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("key", ORACLES)
def test_oracle(spark, key):
    assert differences(QUERIES[key](spark, SF), open_duckdb(SF), ORACLES[key]) is None


def test_shards_are_even(spark):
    sizes = defaultdict(int)
    rows = QUERIES["op1_kd_tree_shards"](spark, SF).collect()
    for r in rows:
        sizes[r.shard] += r["size"]
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in rows)


def test_ngram_join(spark, docs):
    got = sorted(tuple(r) for r in QUERIES["op6_ngram_jaccard_join"](spark, SF).collect())
    assert got == sorted(brute.jaccard_components(docs, 3, 90))


def test_large_groups_are_split(spark, monkeypatch):
    """Blocks of a few tokens, so that groups are cut by more orders and dealt in pairs of chunks."""
    from quietband.llm import ngram_join

    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", 300)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(60):
        own = list(base)
        for k in range(i % 5):
            own[(i * 7 + k * 11) % 60] = f"x{i}-{k}"
        texts.append((i, " ".join(own)))
    got = ngram_join.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string"), 3, 90)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute.jaccard_components(texts, 3, 90))


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_line_dedup(spark, docs, monkeypatch, broadcast_rows):
    """Every text, against lines of any length compared by the shingles of every offset; with both plans of its joins."""
    from quietband.llm import line_dedup

    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", broadcast_rows)
    want = dict(zip((i for i, _ in docs), brute.whole_lines(docs, lambda k: docs[k][0])))
    rows = {r.doc_id: r for r in QUERIES["op8_minhash_line_dedup"](spark, SF).collect()}
    assert len(rows) == len(docs)
    for i, text in want.items():
        assert rows[i].text_sha256 == (None if text is None else hashlib.sha256(text.encode()).hexdigest())
    assert sum(r.lines_gone for r in rows.values()) > 0


@pytest.mark.parametrize("key", NATIVE)
def test_native_plans_run_no_python(spark, key):
    plan = QUERIES[key](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)


def test_licenses(spark, docs):
    rows = {r.doc_id: r for r in QUERIES["op4_positional_license_scan"](spark, SF).collect()}
    word = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for i, text in docs:
        words = word.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        places, labels = [], set()
        for phrase, label in license_scan.BASE:
            p = phrase.split()
            found = [k for k in range(len(words)) if words[k : k + len(p)] == p]
            places += found
            labels |= {label} if found else set()
        r = rows[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(places), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == (min(places, default=None), max(places, default=None))
        assert labels <= set(r.labels.split(",")) | ({""} if not labels else set())


def test_toxicity_on_held_out_rows(spark):
    """Accuracy on labels that the fit has not seen, on a larger table."""
    sf = "/root/testdata/sf0.1"
    scored = {r.doc_id: r for r in QUERIES["op10_compression_toxicity"](spark, sf).collect()}
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    held = [(scored[i], y) for i, y in toxic.items() if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r.held_out for r, _ in held)
    assert sum(r.predicted == y for r, y in held) / len(held) > 0.93
    assert sum(r.predicted for r, y in held if not y) / sum(not y for _, y in held) < 0.03


def test_pipeline(spark, docs):
    """Stage by stage in plain Python; the classifier's decisions come from its model."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = training_model(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    kept = [d for d, s in zip(docs, model.scores([t or "" for _, t in docs])) if s < 0.5]
    kept = [(i, t) for (i, _), t in zip(kept, brute.whole_lines(kept, lambda k: kept[k][0]))]
    least = {i: c for i, _, c in brute.jaccard_components(kept, 5, 80)}
    want = {i for i, _ in kept if least[i] == i}
    got = {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").distinct().collect()}
    assert want == got
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "packing"]

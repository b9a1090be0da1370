"""Every operator on nulls, empty and very long texts, ties, repeated rows, clashing columns and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quietband.llm.bpe import encode_documents
from quietband.llm.exact_dedup import exact_dedup
from quietband.llm.fingerprints import compare_with_edit_and_next
from quietband.llm.license_scan import BASE, TEMPLATES, scan_licenses
from quietband.llm.line_dedup import _sketched, _sketches, dedup_lines
from quietband.llm.ngram_join import jaccard_components, one_per_component
from quietband.llm.packing import WordIds, pack_along_curve
from quietband.llm.sharding import kd_shards
from quietband.llm.toxicity import fit, score_toxicity, training_model, without_toxic
from quietband.llm.warc import round_trip
from tests.llm import brute
from tests.llm.conftest import LINE, ROWS

WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [(r[0], r[1] or "") for r in ROWS]


def library_ids(text):
    return Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids


def test_sharding(edge, nothing):
    rows = kd_shards(edge, shards=3).collect()
    assert Counter(r.text_crc32 for r in rows) == Counter(zlib.crc32(t.encode()) for _, t in TEXTS)
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((i, len(t.encode()) + 1) for i, t in TEXTS)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= {0, 1, 2}
    assert kd_shards(nothing).count() == 0


def test_sharding_of_equal_rows(spark):
    same = spark.range(1000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"),
                                    F.lit("en").alias("lang"), F.lit("s").alias("source"))
    sizes = [r["count"] for r in kd_shards(same, shards=8).groupBy("shard").count().collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 4


def test_archives(spark):
    big = "<p>" + "x" * 3_000_000
    rows = [(3, "u", big), (1, None, big), (2, "u", "short"), (5, "u", "short"), (4, "a\r\nb", None), (1, None, big), (None, "n", big),
            (6, "ü", "WARC/1.1\r\n\r\n" * 20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = Counter(tuple(r) for r in round_trip(pages).collect())
    want = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        other = i != 1 and html == big
        want[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if other else "response", 1 if other else None] += 1
    assert got == want
    assert round_trip(pages.where("false")).count() == 0


def test_packing(edge, nothing):
    pieces, ids = defaultdict(list), {t: library_ids(t) + [2] for t in {t for _, t in TEXTS}}
    sequences = defaultdict(list)
    for r in pack_along_curve(edge, WORDS, size=512).collect():
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
    for spans in sequences.values():
        total = 0
        for at, n in sorted(spans):
            assert at == total
            total += n
        assert total == 512 or total & (total - 1) == 0
    left = {k: Counter(v) for k, v in pieces.items()}
    for i, text in TEXTS:
        own, at = np.array(ids[text], "<u4"), 0
        while at < len(own):
            piece = next(p for p in left[i, len(own)] if p[0] == at and left[i, len(own)][p])
            left[i, len(own)][piece] -= 1
            assert zlib.crc32(own[at : at + piece[1]].tobytes()) == piece[2]
            at += piece[1]
    assert not any(n for c in left.values() for n in c.values())
    assert pack_along_curve(nothing, WORDS).count() == 0


def test_words_that_normalisation_takes_apart():
    """Letters that become a letter and a mark, among plain words; ids as those of the library for the whole text."""
    odd = ["İstanbul", "İ", *(chr(c) + "क" for c in range(0x958, 0x960)), "\ufb2a", "\ufb4bש", "e\u0301té", "ΣΑΣ", "straße", "ﬁn", "ǅ"]
    text = " ".join(f"plain {w} {w}, words{w}" for w in odd)
    got = np.frombuffer(WordIds(WORDS).encode([text])[0], "<u2")
    assert got.tolist() == library_ids(text)


def test_words_in_use_stay_known(monkeypatch):
    """A full memory forgets what the texts at hand do not use; no word of every slice is encoded twice, and ids stay right."""
    monkeypatch.setattr("quietband.llm.packing.KNOWN_WORDS", 60)
    words, sent = WordIds(WORDS), Counter()
    encode = words._ids
    monkeypatch.setattr(words, "_ids", lambda pieces: (sent.update(pieces), encode(pieces))[1])
    for i in range(12):
        text = " ".join(f"many of these Words, come back {chr(97 + i)}{chr(97 + k)}rare" for k in range(20))
        assert np.frombuffer(words.encode([text])[0], "<u2").tolist() == library_ids(text)
    assert max(sent.values()) == 1 and len(words.words) <= 60 and len(words.pieces) <= 60


def test_licenses(edge, nothing):
    rows = {(r.doc_id, r.n_words): r for r in scan_licenses(edge).collect()}
    assert rows[1, 7].base_labels == "mit" and (rows[1, 7].n_base, rows[1, 7].first_word, rows[1, 7].last_word) == (1, 5, 5)
    assert rows[2, 0].labels == "" and rows[2, 0].first_word is None and rows[2, 0].score == 0
    assert scan_licenses(edge).count() == len(ROWS) and scan_licenses(nothing).count() == 0


def test_licenses_of_one_text_do_not_hide_each_other(spark):
    """Labels against a search for the key phrases, in texts with up to all templates."""
    filler = " plain words between the notices" * 12
    parts = [t for _, t, _ in TEMPLATES]
    cut = [(parts[9] + filler).join(["", parts[1], parts[2], parts[12]]), filler.join(parts), filler.join(parts[::-1]), filler.join(parts[::3])]
    phrases = [filler.join([*keys, "of", "0"]) if len(keys) == 1 else t for _, t, keys in TEMPLATES]
    texts = [*cut, *parts, *phrases, filler]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in scan_licenses(docs).collect():
        has = lambda p: f" {p} " in f" {texts[r.doc_id]} "  # noqa: B023, E731
        want = {label for label, _, keys in TEMPLATES if all(map(has, keys))} | {label for phrase, label in BASE if has(phrase)}
        assert set(filter(None, r.labels.split(","))) == want


def test_exact_dedup(edge, nothing):
    groups = defaultdict(list)
    for i, t in TEXTS:
        groups[hashlib.sha256(t.encode()).hexdigest()].append(i)
    rows = exact_dedup(edge).collect()
    assert Counter((r.doc_id, r.text_sha256) for r in rows) == Counter((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in TEXTS)
    for r in rows:
        ids = [i for i in groups[r.text_sha256] if i is not None]
        assert r.group_size == len(groups[r.text_sha256]) and r.keep_id == max(ids, default=None)
    assert Counter(r.text_sha256 for r in rows if r.kept) == Counter(groups.keys())
    assert exact_dedup(nothing).count() == 0


def test_ngram_join(edge, nothing):
    got = Counter(tuple(r) for r in jaccard_components(edge, 3, 90).collect())
    assert got == Counter(brute.jaccard_components([(i, t) for i, t in TEXTS], 3, 90))
    kept = [r.doc_id for r in one_per_component(edge, 3, 90).collect()]
    assert Counter(kept) == Counter([1, 2, 3, 4, 7, None, 9, 10, 11, 12, 13])
    assert jaccard_components(nothing).count() == 0 and one_per_component(nothing).count() == 0


def test_bpe(edge, nothing):
    decode = Tokenizer.from_file(WORDS).decode
    want = Counter()
    for i, t in TEXTS:
        ids = library_ids(t)
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in encode_documents(edge, WORDS).collect()) == want
    assert encode_documents(nothing, WORDS).count() == 0


def test_line_dedup(edge, nothing):
    out = dedup_lines(edge, length_col="n_chars")
    assert out.columns == [*edge.columns, "lines_before", "lines_gone"]
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(ROWS) and rows[2].text is None and rows[3].text == ""
    assert rows[10].text.endswith(LINE) and rows[11].text == "other words of eleven" and rows[12].text == "last words"
    assert rows[11].n_chars == len(rows[11].text) and rows[4].text and rows[5].text == "" and rows[5].lines_gone == 1
    assert dedup_lines(nothing).count() == 0


def test_a_text_of_very_many_lines(spark):
    """Rewriting takes time in proportion to the lines."""
    lines = [f"line {i // 2}" for i in range(100_000)]
    docs = spark.createDataFrame([(0, "\n".join(lines))], "doc_id long, text string")
    row, = dedup_lines(docs).collect()
    assert row.lines_before == 100_000 and row.lines_gone == 50_000
    assert row.text == "\n".join(lines[::2])


def test_lines_that_differ_late_in_long_words_stay(spark):
    """Two lists of addresses whose words share their first 16 characters."""
    lists = [" ".join(f"https://www.example.com/{kind}/{i}" for i in range(n)) for kind, n in (("articles", 10), ("products", 64))]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*lists, lists[1] + " end"])], "doc_id long, text string")
    rows = {r.doc_id: r for r in dedup_lines(docs).collect()}
    assert [rows[i].text for i in range(3)] == [*lists, ""]


def test_short_lines_and_lines_without_blanks(spark):
    """Equal lines go at any length and in any script; blank lines stay."""
    han = "".join(chr(0x4E00 + i) for i in range(200))
    other = "".join(chr(0x6E00 + i) for i in range(200))
    texts = ["Menu\n\na\tb\tc", f" Menu\n\n{han}", f"{other}\n{han}x", "a\tb\tc\nmenu"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r for r in dedup_lines(docs).collect()}
    assert [rows[i].text for i in range(4)] == [texts[0], f"\n{han}", other, "menu"]
    assert [rows[i].text for i in range(4)] == brute.whole_lines(list(enumerate(texts)), lambda k: k)


def test_every_pair_of_lines_at_the_threshold(spark):
    """No link is left to chance: lines barely alike, alone in pairs and in crowds that share a passage."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n)).strip().ljust(n, "z")
    texts = []
    for _ in range(400):
        line = word(215)
        # 180 of 200 + 20 shingles or of 200 + 25: alike, or not by a little.
        texts += [line, line[:195] + word(rng.choice((20, 22, 25, 28)))]
    passage = word(150)
    texts += [passage + word(rng.randrange(20, 60)) for _ in range(120)]
    stem = passage + word(50)
    texts += [stem + word(rng.randrange(8, 24)) for _ in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.text for r in dedup_lines(docs).orderBy("doc_id").collect()]
    assert got == brute.whole_lines(list(enumerate(texts)), lambda k: k)
    assert 0 < got.count("") < len(texts) / 2


def test_lines_send_few_hashes_and_share_one_with_each_near_copy(spark):
    """A seventh of a line's shingles at most where words are short, and no near copy without a common one: edits, moved and
    doubled parts, lines of few letters, periodic ones and ones without blanks."""
    rng = random.Random(11)
    word = lambda a, n: "".join(rng.choices(a, k=n))
    prose = [" ".join(word("abcdefghijklmnop", rng.randrange(2, 9)) for _ in range(80)) for _ in range(150)]
    odd = [word(rng.choice(("ab", "abc ", "abcdefgh  ")), rng.randrange(30, 200)) for _ in range(150)]
    odd += [(word("abcdefgh ", rng.randrange(1, 40)) * 99)[: rng.randrange(30, 200)] for _ in range(150)]
    lines = [x.strip(" ") for x in prose + odd]
    for x in list(lines):
        for _ in range(3):
            y = x
            for _ in range(rng.randrange(1, 5)):
                lo, hi = sorted(rng.randrange(len(y) + 1) for _ in "ab")
                y = rng.choice((y[:lo] + word("abq ", 3) + y[lo:], y[:lo] + y[lo + 2 :], y[hi:] + y[lo:hi] + y[:lo], y[:hi] + y[lo:hi] + y[hi:])) or x
            lines.append(y.strip(" "))
    rows = spark.createDataFrame(list(enumerate(lines)), "line_id long, line string")
    held = defaultdict(set)
    for r in _sketched(rows, 0).collect():
        held[r.line_id].add(r.token)
    sets = [{x[i : i + 16] for i in range(max(1, len(x) - 15))} for x in lines]
    n = len(prose) + len(odd)
    pairs = [(i, n + 3 * i + k) for i in range(n) for k in range(3) if lines[i] != lines[n + 3 * i + k]]
    alike = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and len(lines[a]) > 15]
    assert len(alike) > 300 and all(held[a] & held[b] for a, b in alike)
    assert sum(len(held[i]) for i in range(len(prose))) < sum(len(sets[i]) for i in range(len(prose))) / 7


def test_lines_of_few_syllables_send_few_hashes(spark):
    """A twelfth of the shingles at most where words repeat syllables, as many common marks as each line needs, and a common hash with
    each near copy, also beyond the basic plane and where a line repeats itself."""
    rng = random.Random(5)
    parts = "an en in on ed er re ti th sh he nd st ly ea or é 漢".split()
    word = lambda: "".join(rng.choices(parts, k=rng.choice((1, 2, 2, 3, 4))))
    prose = [" ".join(word() for _ in range(rng.randrange(20, 120))) for _ in range(300)]
    odd = [x[:50] + "😀 and 😀" + x[50:] for x in prose[:50]] + [" ".join(w for _ in range(9) for w in x.split()[:7]) for x in prose[:50]]
    lines = prose + odd
    for x in list(lines):
        for _ in range(4):
            y = x
            for _ in range(rng.randrange(1, 9)):
                lo = rng.randrange(len(y) + 1)
                hi = min(len(y), lo + rng.randrange(1, 40))
                y = rng.choice((y[:lo] + word() + y[lo:], y[:lo] + y[lo + 2 :], y[:lo] + y[hi:] + y[lo:hi], y[:hi] + y[lo:hi] + y[hi:])) or x
            lines.append(y.strip(" "))
    rows = {r.line_id: r for r in _sketches(spark.createDataFrame(list(enumerate(lines)), "line_id long, line string"), 0).collect()}
    sets = [{x[i : i + 16] for i in range(max(1, len(x) - 15))} for x in lines]
    marks = [{s for s in held if re.fullmatch(r"..[^ ]{5} .{8}", s, re.S)} for held in sets]
    n = len(prose) + len(odd)
    pairs = [(i, n + 4 * i + k) for i in range(n) for k in range(4) if lines[i] != lines[n + 4 * i + k]]
    alike = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert len(alike) > 300 and all(set(rows[a].tokens) & set(rows[b].tokens) for a, b in alike)
    assert all(len(marks[a] & marks[b]) >= max(rows[a].need, rows[b].need) for a, b in alike)
    assert all(rows[i].marks == len(marks[i]) and rows[i].least <= len(sets[i]) <= rows[i].most for i in rows)
    assert sum(len(rows[i].tokens) for i in range(len(prose))) < sum(len(sets[i]) for i in range(len(prose))) / 12


def test_line_dedup_keeps_no_shuffle_of_a_stored_step(edge, monkeypatch):
    """While steps are stored, Spark deletes their shuffle files at once; the session's own setting is as before afterwards."""
    from quietband.llm import line_dedup

    conf, kept, seen = edge.sparkSession.conf, line_dedup.stored, set()
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, "false")

    def stored(rows, label, *args, **kwargs):
        seen.add(conf.get(name, "false"))
        return kept(rows, label, *args, **kwargs)

    monkeypatch.setattr(line_dedup, "stored", stored)
    assert dedup_lines(edge).count() == edge.count()
    assert seen == {"true"} and conf.get(name, "false") == before


def test_fingerprints(edge, nothing):
    rows = compare_with_edit_and_next(edge).collect()
    ids = [r.doc_id for r in rows]
    assert Counter(ids) == Counter(i for i, _ in TEXTS)
    got = {r.doc_id: r for r in rows}
    assert got[4].fingerprint == got[5].fingerprint and got[4].near_next == 1 and got[2].fingerprint == got[3].fingerprint
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0))
    for k, (i, t) in enumerate(order):
        cut, after = len(t) // 4, order[(k + 1) % len(order)][1]
        edited = t[: len(t) - cut] + after[:cut]
        a, b, c = map(brute.paragraphs, (t, edited, after))
        assert got[i].n_chars == len(t)
        if i != 7:
            assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert got[i].near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1)
            assert got[i].near_next == pytest.approx(len(a & c) / len(a | c) if a | c else 1)
    assert compare_with_edit_and_next(nothing).count() == 0


def test_toxicity(spark, edge, nothing):
    bad = [f"plain words {i} you vile grobian and {i * 7} other words" for i in range(40)]
    good = [f"plain words {i} you kind person and {i * 7} other words" for i in range(80)]
    model = fit(bad, good, 1 / 3)
    assert model.scores(bad).mean() > 0.5 > model.scores(good).mean()
    rows = score_toxicity(edge, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    kept = without_toxic(edge, model)
    assert kept.columns == edge.columns and kept.count() == sum(not r.predicted for r in rows)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert score_toxicity(nothing, training_model(nothing, labels)).count() == 0
    assert {r.score for r in score_toxicity(edge, training_model(edge, labels)).collect()} == {0.0}


def test_lines_that_share_a_passage_are_not_multiplied(spark, monkeypatch):
    """A crowd around a passage writes no more rows in any step than its lines share hashes, and loses none of its links."""
    from quietband.llm import line_dedup

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))
    words = lambda n: " ".join(word() for _ in range(n))
    passage, texts = words(14), []
    for _ in range(100):
        line = f"{words(25)} {passage} {words(25)}"
        texts += [line, line + " " + words(6)]
    written, kept = {}, line_dedup.stored

    def stored(rows, label, *args, **kwargs):
        out = kept(rows, label, *args, **kwargs)
        written[label] = out.count()
        return out

    monkeypatch.setattr(line_dedup, "stored", stored)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.text for r in dedup_lines(docs).orderBy("doc_id").collect()]
    assert got == brute.whole_lines(list(enumerate(texts)), lambda k: k)
    assert got.count("") == 100
    assert max(written.values()) == written["line-shared"]

"""Toxicity, fill-in-middle and periodic runs against brute force and held-out labels."""

import hashlib
import random
import re
import zlib

import corpus
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import fim_rotation, periodic_runs, toxic_cnn
from tidemark.llm.queries import QUERIES, runs_digests, with_planted_periods

SF = "/root/testdata/sf0.01"
sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


def odd_texts():
    rng = random.Random(9)
    period = corpus.words(rng, 37).split()
    some = [(200, "same " * 30_000), (201, " ".join(period * 40 + period[:5])), (202, "a <P> b"), (203, "<S><M>"), (204, "<"), (205, "ж<S" + "é" * 70_000 + "ab")]
    return corpus.odd_rows() + [(i, t, "z") for i, t in some]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    clashing = ("n", "form", "output", "restored", "runs", "collapsed", "made", "label", "words", "place", "of", "predicted")
    made = corpus.documents(spark, odd_texts()).withColumns({c: F.lit("x") for c in clashing})
    made.repartition(5).write.parquet(path + "/docs")
    return spark.read.parquet(path + "/docs")


def test_empty_tables(odd):
    nothing = odd.limit(0)
    model = toxic_cnn.train(nothing, nothing.select("doc_id", F.lit(1).alias("label")))
    assert toxic_cnn.scored(nothing, model).count() == 0
    assert fim_rotation.restored(fim_rotation.transformed(nothing)).count() == 0
    assert periodic_runs.collapsed(nothing).count() == 0
    assert runs_digests(periodic_runs.collapsed(with_planted_periods(nothing))).count() == 0


# Toxicity --------------------------------------------------------------------------------


def test_toxic_words_are_learned_and_clean_rows_left_alone(spark):
    got = {r.doc_id: r for r in QUERIES["op11_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    held = [(got[r.doc_id].predicted, r.toxic, got[r.doc_id].score) for r in labels if got[r.doc_id].held_out]
    assert len(held) > 500 and sum(p == y for p, y, _ in held) / len(held) >= 0.97
    assert sum(p for p, y, _ in held if y == 0) <= 0.015 * len(held)
    assert sum(p for p, y, _ in held if y == 1) >= 0.85 * sum(y for _, y, _ in held)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    assert all(r.predicted == (r.score >= 0.5) for r in got.values())


def test_labels_of_one_kind_or_none(odd):
    labels = lambda *values: odd.select("doc_id", F.explode(F.array(*map(F.lit, values))).alias("label"))
    scores = {r.score for r in toxic_cnn.scored(odd, toxic_cnn.train(odd, labels(None))).collect()}
    assert scores == {0.5}
    (score,) = {r.score for r in toxic_cnn.scored(odd, toxic_cnn.train(odd, labels(1))).collect()}
    assert 0.9 < score < 1


def test_toxicity_of_odd_rows(odd):
    bad = F.col("doc_id") % 3 == 0
    model = toxic_cnn.train(odd, odd.select("doc_id", F.when(bad, 1).otherwise(0).alias("label")))
    rows = [(r.doc_id, r.score) for r in toxic_cnn.scored(odd, model).collect()]
    assert len(rows) == odd.count() and all(0 <= s <= 1 for _, s in rows)
    by_id = {}
    for i, s in rows:
        by_id.setdefault(i, []).append(s)
    assert by_id[1] == by_id[2] == by_id[3]  # null, empty, white space
    assert len({s for i in range(6, 11) for s in by_id[i]}) == 1 and len(set(by_id[41])) == 1


def test_blocks_do_not_change_what_is_pooled(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 2**32, n, dtype=np.uint32) for n in (0, 1, 2, 3, 40, 41)]
    model = toxic_cnn.first_model(texts * 3, np.array([0, 1] * 9), rng)[0]
    model.tables[:] = rng.normal(0, 1, model.tables.shape)
    whole = [model.pooled(t) for t in texts]
    monkeypatch.setattr(toxic_cnn, "BLOCK", 7)
    assert all(np.allclose(a, model.pooled(t), atol=1e-4) for a, t in zip(whole, texts))
    # By hand: the response of each filter at each place.
    for text, best in zip(texts, whole):
        x, at = model.vectors(text), 0
        for k, width in enumerate(toxic_cnn.WIDTHS):
            for f in range(toxic_cnn.FILTERS):
                u = k * toxic_cnn.FILTERS + f
                every = [sum(x[i + j] @ model.filters[:, at + j, f] for j in range(width)) + model.bias[u] for i in range(len(x) - width + 1)]
                assert best[u] == pytest.approx(max([0, *every]), abs=1e-3)
            at += width


def test_thresholds_follow_the_language():
    assert [toxic_cnn.language(toxic_cnn.word_hashes(t.encode())) for t in ("", "zzz", "Und das, IST nicht!", "the cat and the dog", "le chat et les chiens")] == [
        "other", "other", "de", "en", "fr",
    ]
    margins, y = np.array([5.0, 4, 3, 2, 2, 1]), np.array([1, 1, 0, 0, 1, 0])
    assert toxic_cnn.best_threshold(margins, y, np.ones(6)) == 3.5
    assert toxic_cnn.best_threshold(margins, y, np.where(y == 1, 1, 0.01)) == 1.5


# Fill-in-middle --------------------------------------------------------------------------


def in_the_middle(doc_id, text):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text or "", re.S)
    n, digest = len(units), sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text or ""
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_texts_are_cut_rearranged_and_restored(odd):
    made = fim_rotation.restored(fim_rotation.transformed(odd))
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    want = [(i, *in_the_middle(i, t), t or "") for i, t, _ in odd_texts()]
    assert sorted(map(repr, map(tuple, made.collect()))) == sorted(map(repr, want))
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


@settings(max_examples=300, deadline=None)
@given(st.text("aZ <SPM>é漢\n😀", max_size=40), st.lists(st.integers(0, 2**32 - 1), min_size=4, max_size=4), st.sampled_from([1, 2, 5, 1 << 16]))
def test_rotations_invert(text, draws, block):
    held, fim_rotation.BLOCK = fim_rotation.BLOCK, block
    try:
        n, form, p, m, out = fim_rotation.cut_and_arranged(text.encode(), draws)
        assert n == len(re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S))
        assert fim_rotation.restore(out, form) == text.encode()
        if form != "plain":
            first, second = (len(text[:k].encode()) for k in (p, p + m))
            parts = {"P": text.encode()[:first], "M": text.encode()[first:second], "S": text.encode()[second:]}
            order = "PSM" if form == "psm" else "SPM"
            assert out == b"".join(b"<%s>" % k.encode() + parts[k] for k in order)
    finally:
        fim_rotation.BLOCK = held


# Periodic runs ---------------------------------------------------------------------------


def all_runs(words, least=24, periods=3):
    """Start, length, smallest period: by looking at every period and place."""
    n, out = len(words), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(least, periods * q) and i > start:
                out.setdefault((start, length), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str("" if doc_id is None else doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def digests(doc_id, words):
    found = all_runs(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(found), *best, milli, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_planted_rows_by_brute_force(spark, odd):
    # Every third id of so many is planted, so that there are some of each.
    small = [(i, t) for i, t, _ in odd_texts() if len(t or "") < 20_000]
    rng = random.Random(3)
    small += [(1000 + i, corpus.words(rng, rng.randint(0, 90))) for i in range(300)]
    docs = spark.createDataFrame(small, "doc_id long, text string")
    got = runs_digests(periodic_runs.collapsed(with_planted_periods(docs)))
    want = [digests(i, planted(i, t)) for i, t in small]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert sum(w[1] > 0 for w in want) >= 10


def test_query_on_short_documents_by_brute_force(spark):
    rows = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    docs = [(r.doc_id, planted(r.doc_id, r.text)) for r in spark.read.parquet(SF + "/documents.parquet").collect()]
    assert len(rows) == len(docs)
    checked = [(i, words) for i, words in docs if len(words) <= 400]
    assert len(checked) > 500 and all(rows[i] == digests(i, words) for i, words in checked)


def test_runs_of_odd_rows(odd):
    made = {}
    for r in periodic_runs.collapsed(odd).collect():
        made.setdefault(r.doc_id, []).append(r)
    assert [tuple(x) for x in made[200][0].runs] == [(0, 30_000, 1)] and made[200][0].collapsed == "same"
    assert [tuple(x) for x in made[201][0].runs] == [(0, 37 * 40 + 5, 37)] and made[201][0].collapsed.split() == made[201][0].collapsed.split()[:37]
    assert [tuple(x) for x in made[32][0].runs] == [(0, 5_000, 1)]
    assert all(made[i][0].n_words == 0 and made[i][0].runs == [] and made[i][0].collapsed == "" for i in (1, 2, 3))
    assert len(made[40]) == len(made[41]) == 2 and len(made[None]) == 3


words_of_few = st.lists(st.tuples(st.lists(st.integers(1, 3), min_size=1, max_size=9), st.integers(1, 12)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(words_of_few, st.sampled_from([(24, 3), (2, 2), (5, 4)]), st.sampled_from([16, 1 << 20]))
def test_runs_by_brute_force(blocks, rule, pairs):
    ids = np.array([w for block, times in blocks for w in block * times], np.int64)
    held, periodic_runs.PAIRS = periodic_runs.PAIRS, pairs
    try:
        assert [tuple(r) for r in periodic_runs.runs(ids, *rule).tolist()] == all_runs(ids.tolist(), *rule)
    finally:
        periodic_runs.PAIRS = held


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 2), min_size=2, max_size=150), st.integers(1, 40))
def test_extensions_by_brute_force(block, times):
    ids = np.array((block * times)[:400], np.int64)
    rng = np.random.default_rng(len(ids))
    i = rng.integers(0, len(ids), 200)
    j = rng.integers(0, len(ids) + 1, 200)
    i, j = np.minimum(i, j), np.maximum(i, j)
    i, j = i[i < j], j[i < j]

    def common(a, b):
        k = 0
        while b + k < len(ids) and ids[a + k] == ids[b + k]:
            k += 1
        return k

    assert periodic_runs.Extensions(ids)(i, j).tolist() == [common(a, b) for a, b in zip(i.tolist(), j.tolist())]

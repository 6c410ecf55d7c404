"""Ranked search, whitening and passages against brute force."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest

from regweave.llm import bidiagonal, passages, ranked_search, whitening

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# -- op13 -------------------------------------------------------------------------


def terms(text):
    return TERMS.findall((text or "").translate(str.maketrans(ranked_search.UPPER, ranked_search.LOWER)))


def ranking(items, docs, top):
    """(item_id, rank, doc_id, score) of every item by looking at all documents."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        found = []
        for d, c in counts:
            m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if t in c
            )
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item_id, k + 1, None if late else d, -s) for k, (s, late, d) in enumerate(sorted(found)[:top])]
    return Counter(out)


ITEMS = [(1, "La one TWO sentence é"), (1, "la la x"), (None, "write card 4111 host"), (2, None), (3, "  .,;"), (4, "nowhere zzzzqq"), (5, "LA" * 3 + " ü 🙂 x")]


@pytest.mark.parametrize("top, owners, block, group", [(50, 4, 2048, 200), (3, 3, 5, 2), (1, 1, 1, 1)])
def test_ranking_is_that_of_all_documents(spark, docs, top, owners, block, group):
    items = spark.createDataFrame([(i, t, "x", 7) for i, t in ITEMS], "item_id long, text string, item string, grp int")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    extra = [(100 + k, " ".join(t for _, text in ITEMS[:3] for t in terms(text)[: k % 5 + 1])) for k in range(40)]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string")).repartition(3)
    got = ranked_search.search(items, more, top=top, owners=owners, block=block, group=group).collect()
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == ranking(ITEMS, texts + extra, top)


def test_ranking_of_empty_tables(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked_search.search(items, empty).count() == 0
    assert ranked_search.search(items.limit(0), docs).count() == 0


def test_terms_are_the_pattern():
    text = "aZ9é_b-c\x7fd\x00e 🙂🙂xİKK@`{[/:"
    assert [t.decode() for t in ranked_search.terms_of(text)] == terms(text)


# -- op11 -------------------------------------------------------------------------


def test_singular_values_and_vectors():
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    wide = rng.standard_normal((200, 20))
    wide[:, 5], wide[:, 7] = 0, wide[:, 3]
    cases = [np.triu(rng.standard_normal((n, n))) for n in (1, 2, 3, 8, 40)]
    cases += [np.eye(10), np.diag([3.0, 3, 3, 2, 2, 1, 1, 1, 0, 0]), np.zeros((4, 4)), np.linalg.qr(wide, mode="r")]
    cases += [np.linalg.qr(q * np.array([5.0, 5 - 1e-9, 5 - 2e-9, 4, *[3.0] * 4, *[1.0] * 22]) @ q.T, mode="r")]
    cases += [np.triu(rng.standard_normal((20, 20))) * 10.0 ** -np.arange(20)]
    for r in cases:
        values, vectors = bidiagonal.largest(r, 8)
        want = np.linalg.svd(r)[1] ** 2
        assert np.abs(values - want).max() <= 1e-13 * max(want[0], 1e-300)
        rank = int((want > 1e-24 * want[0]).sum()) if want[0] else 0
        assert vectors.shape[1] == min(8, rank)
        if rank:
            assert np.abs(vectors.T @ vectors - np.eye(vectors.shape[1])).max() < 1e-11
            assert np.abs(r.T @ (r @ vectors) - vectors * values[: vectors.shape[1]]).max() < 1e-12 * want[0]


def test_small_values_keep_their_digits():
    a = 10.0 ** -np.arange(0, 24, 2.0)
    b = a[:-1] * 0.3
    values = bidiagonal.squared_values(a, b)
    assert abs(np.prod(values) / np.prod(a) ** 2 - 1) < 1e-12  # the determinant, with its smallest factor


SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec int, h string"


def table_of(spark, vectors):
    return spark.createDataFrame([(k, v, 1, "i", 2, "h") for k, v in vectors], SCHEMA)


def test_whitening_against_the_covariance(spark):
    rng = np.random.default_rng(1)
    base = (rng.standard_normal((300, 12)) @ np.diag(2.0 ** -np.arange(12)) @ rng.standard_normal((12, 12))).astype(np.float32)
    good = [(k, [float(x) for x in v]) for k, v in enumerate(base)]
    good += [(7, good[7][1])] * 20 + [(None, good[3][1])]
    bad = [(900, None), (901, [None] + good[0][1][1:]), (902, [math.nan] + good[0][1][1:]), (903, [math.inf] + good[0][1][1:]),
           (904, [1.0, 2.0]), (905, []), (906, [3e38] + good[0][1][1:])]
    rows = whitening.whiten(table_of(spark, good + bad).repartition(5)).collect()
    x = np.floor(1024 * np.array([v for _, v in good], dtype=np.float32).astype(float)) + 100000
    n, y = len(x), x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    white = y @ vectors[:, :8] / np.sqrt(values[:8])
    assert len(rows) == 8 * n and {r.n for r in rows} == {n}
    assert max(r.identity_error for r in rows) < 1e-9 and len({r.identity_error for r in rows}) == 1
    sums = [int(s) for s in x.sum(axis=0)]
    far = {k: sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for (k, _), row in zip(good, x)}
    want = dict(zip([k for k, _ in good], white))
    for c in range(1, 9):
        own = [r for r in rows if r.component == c]
        sign = np.sign(sum(r.whitened * want[r.vec_id][c - 1] for r in own))
        for r in own:
            assert abs(r.whitened * sign - want[r.vec_id][c - 1]) < 1e-8
            assert abs(r.explained / (values[c - 1] / values.sum()) - 1) < 1e-10
            assert r.deviation == far[r.vec_id] and r.deviation_text == str(far[r.vec_id])


def test_whitening_of_little(spark):
    assert whitening.whiten(table_of(spark, [])).count() == 0
    assert whitening.whiten(table_of(spark, [(1, None), (2, [math.nan])])).count() == 0
    assert whitening.whiten(table_of(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0])])).count() == 0
    rows = whitening.whiten(table_of(spark, [(1, [0.0, 5.0]), (2, [0.0, 7.0]), (3, [0.0, 9.0])])).collect()
    assert sorted((r.vec_id, r.component) for r in rows) == [(1, 1), (2, 1), (3, 1)]
    assert sorted(abs(r.whitened) for r in rows) == pytest.approx([0, 1.5**0.5, 1.5**0.5])
    huge = whitening.whiten(table_of(spark, [(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [1e15, 3.0])])).collect()
    wide = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in ([1e15, 0.0], [-1e15, 1.0], [1e15, 3.0])]
    sums = [sum(c) for c in zip(*wide)]
    far = {k + 1: sum((3 * a - s) ** 2 for a, s in zip(v, sums)) for k, v in enumerate(wide)}
    assert all(r.deviation is None and r.deviation_text == str(far[r.vec_id]) for r in huge)


def test_factors_are_stacked_in_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "BLOCK", 3)
    rng = np.random.default_rng(2)
    table = table_of(spark, [(k, [float(x) for x in rng.standard_normal(5)]) for k in range(90)]).repartition(11)
    model = whitening.fit(whitening.vectors(table, "vec_id", "embedding"), 5)
    x = np.floor(1024 * np.array([r.embedding for r in table.collect()], dtype=np.float32).astype(float)) + 100000
    assert np.abs(model.values / np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1] - 1).max() < 1e-11


# -- op12 -------------------------------------------------------------------------


def without_passages(texts, window):
    """For each text its words, kept words and removed runs, by looking at every window."""
    words = [WORDS.findall(t or "") for t in texts]
    seen = Counter(tuple(w[k:k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone |= set(range(k, k + window))
        runs = sum(k - 1 not in gone for k in gone)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((len(w), len(gone), runs, kept))
    return out


@pytest.mark.parametrize("window, gram, crowd", [(35, 8, 10_000), (12, 5, 10_000), (12, 5, 1), (6, 6, 2), (5, 1, 1)])
def test_passages_are_all_found(docs, monkeypatch, window, gram, crowd):
    monkeypatch.setattr(passages, "CROWD", crowd)
    rows = docs.collect()
    want = Counter((r.doc_id, *w) for r, w in zip(rows, without_passages([r.text for r in rows], window)))
    got = passages.remove_passages(docs, window=window, gram=gram).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.n_spans, r.kept) for r in got) == want
    assert any(w[2] for w in want)


def test_passages_at_many_offsets(spark):
    rng = np.random.default_rng(3)
    line = [str(x) for x in rng.integers(0, 4, 400)]  # few words, so anchors recur
    texts = [" ".join(line[a:a + n]) for a, n in zip(rng.integers(0, 300, 60).tolist(), rng.integers(1, 100, 60).tolist())]
    texts += ["a " * 200, "a b " * 60, " ".join(line[:50] + ["x"] + line[51:120])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, r.n_spans, r.kept) for r in passages.remove_passages(frame, window=20, gram=4).collect()}
    assert [got[k] for k in range(len(texts))] == without_passages(texts, 20)


def test_passages_query_and_empty_table(spark, docs, empty, monkeypatch):
    assert passages.remove_passages(empty).count() == 0
    monkeypatch.setattr(passages, "table", lambda *_: docs)
    rows = docs.collect()
    want = Counter(
        (r.doc_id, n, gone, hashlib.sha256(kept.encode()).hexdigest())
        for r, (n, gone, _, kept) in zip(rows, without_passages([r.text for r in rows], 35))
    )
    got = passages.op12_remove_passages(spark, "").collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want

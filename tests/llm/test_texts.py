"""Operators that look at one text at a time, against brute force."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from regweave.llm import packing, pii, quality, token_counts
from regweave.llm.common import scratch


@pytest.fixture(scope="module")
def ids():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_packing_places_every_id_once(docs, ids):
    limits = packing.Limits(tokens=64, segments=4, loss_tokens=50)
    rows = packing.pack(docs, limits=limits).collect()
    want = Counter((r.doc_id, tuple(ids(r.text) + [0])) for r in docs.collect())
    pieces = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length
        pieces.setdefault(r.doc_id, {}).setdefault(r.start, []).append(np.frombuffer(r.ids, "<u4").tolist())
    for (doc_id, whole), copies in want.items():
        if sum(k[0] == doc_id for k in want) == 1:
            got = [p for s in sorted(pieces[doc_id]) for p in pieces[doc_id][s][:1]]
            assert copies > 1 or [x for p in got for x in p] == list(whole)
    assert sum(r.length for r in rows) == sum(len(w) * c for (_, w), c in want.items())
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        assert sum(r.length for r in own) <= 64 and len(own) <= 4 and sum(r.loss_tokens for r in own) <= 50


def test_packed_ids_are_those_of_the_unaltered_tokenizer(spark, docs, monkeypatch):
    from regweave.llm.tokens import added_tokens

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [end, end * 2, f"a {end} b", f"one\n\n {end}  two{end}", f" {end[:-1]} {end}x", f"x  {end} \n y", "no token"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(docs.where("doc_id > 99 or doc_id = 19").select("doc_id", "text"))
    want = Counter((r.doc_id, tuple(plain.encode(r.text or "", add_special_tokens=False).ids + [0])) for r in table.collect())
    assert sum(50256 in x for _, x in want) == 7
    rows = packing.pack(table, added=added_tokens()).where("length = doc_tokens").collect()
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows) <= want and len(rows) >= len(want) - 1
    monkeypatch.setattr(packing, "table", lambda *_: table)
    packed = packing.op2_pack_documents(spark, "").collect()
    assert sorted((r.doc_id, r.doc_tokens) for r in packed if not r.start) == sorted((i, len(x)) for i, x in want.elements())
    crcs = {(i, zlib.crc32(np.array(x, dtype="<u4").tobytes())) for i, x in want}
    assert all((r.doc_id, r.ids_crc32) in crcs for r in packed if r.length == r.doc_tokens)


def test_packing_fills_sequences(docs):
    rows = packing.pack(docs.coalesce(1)).groupBy("sequence_id").sum("length").collect()
    assert sorted(r[1] for r in rows)[1:] == [1024] * (len(rows) - 1)


def test_prompts_bear_no_loss(spark):
    table = spark.createDataFrame([(1, "tell me more about it", 12), (2, "yes", None)], "doc_id long, text string, p int")
    rows = {r.doc_id: r for r in packing.pack(table, prompt_chars="p").collect()}
    assert 0 < rows[1].loss_tokens < rows[1].length and rows[2].loss_tokens == rows[2].length


@pytest.mark.parametrize("block", [1 << 20, 7, 1])
def test_token_counts_over_any_blocks(spark, docs, ids, block):
    path = scratch(spark, "flat")
    places = token_counts.write_flat(docs, path)
    spans = token_counts.document_spans(token_counts.read_flat(spark, path), block=block)
    assert places.count() == docs.count() == spans.where("terminated").count()
    want = sorted(len(ids(r.text)) for r in docs.collect())
    assert sorted(r.n_tokens for r in spans.collect()) == want


def test_unterminated_and_empty_documents(spark):
    flat = np.array([50256, 5, 6, 50256, 50256, 7], dtype="<u2").tobytes()
    files = spark.createDataFrame([("f", flat), ("g", b"")], "path string, content binary")
    rows = token_counts.document_spans(files, block=2).orderBy("ordinal").collect()
    assert [(r.n_tokens, r.terminated) for r in rows] == [(0, True), (2, True), (0, True), (1, False)]


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i in range(len(words) - 2) for k in range(3) if seen[tuple(words[i:i + 3])] > 1}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)]


def test_quality_counts(docs):
    for r in docs.select("doc_id", "text", quality.text_counts("text").alias("c")).collect():
        assert list(r.c)[:5] == brute_counts(r.text)


def test_quality_keeps_clean_and_drops_junk(spark):
    import random

    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdeionrst") for _ in range(rng.randint(2, 9)))
    clean = [(k, " ".join(word() for _ in range(120)) + ".") for k in range(300)]
    junk = [(1000 + k, " ".join(word().upper() + "!!" for _ in range(120))) for k in range(20)]
    junk += [(2000 + k, " ".join(word() + "###" for _ in range(120))) for k in range(20)]
    table = spark.createDataFrame(clean + junk, "doc_id long, text string")
    kept = {r.doc_id for r in quality.keep_good(table).collect()}
    assert kept == {k for k, _ in clean}
    verdicts = quality.verdicts(quality.measured(spark.createDataFrame(clean, "doc_id long, text string")))
    assert verdicts.where("not kept").count() == 0  # nothing to object to, nothing goes


def test_quality_rows_and_columns_stay(docs, empty):
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and set(kept.collect()) <= set(docs.collect())
    assert quality.verdicts(quality.measured(empty)).count() == 0 and quality.keep_good(empty).count() == 0


def brute_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_base_patterns(docs, empty):
    import random

    from pyspark.sql import functions as F

    for r in docs.select("text", pii.spans_of(F.col("text"), pii.Model()).alias("s")).collect():
        assert r.s.base == r.s.spans == brute_spans(r.text)
    rng = random.Random(3)
    for _ in range(2000):
        text = "".join(rng.choice("01239.-+@ a%()ab.c4") for _ in range(rng.randint(0, 60)))
        assert pii._joined(pii.find(text, lambda zone: ())[0]) == brute_spans(text)
    assert pii.mask(empty).count() == 0


def test_semi_markov_decoding_is_the_best_segmentation():
    zones = [("a1@b.c", frozenset({("email", 0, 6)}), 5), ("10.1.2.3", frozenset({("ip", 0, 8)}), 5), ("12 of 9", frozenset(), 5)]
    model = pii.train(zones)
    for zone, labels, _ in zones:
        assert set(model.decode(zone)) == labels
    for zone in ("x 10.1.2.3 4", "7 a1@b.c,10.0.0.1"):
        atoms, found = pii.lattice(zone)
        edges = [(i, j, k, model.score(k, f)) for i, j, f in found for k in pii.KINDS]

        def best(i):
            if i == len(atoms):
                return 0.0
            return max([best(i + 1)] + [s + best(j) for a, j, _, s in edges if a == i])

        by_span = {(atoms[i][0], atoms[j - 1][1], k): s for i, j, k, s in edges}
        assert abs(sum(by_span[a, b, k] for k, a, b in model.decode(zone)) - best(0)) < 1e-9


def test_mask_replaces_spans(spark):
    rows = [(k, f"mail u{k}@mail{k}.example.com now", 0) for k in range(30)] + [(99, None, None), (100, "clean 3.0 text", 0)]
    out = {r.doc_id: r for r in pii.mask(spark.createDataFrame(rows, "doc_id long, text string, n_chars long")).collect()}
    assert out[5].text == "mail [EMAIL] now" and out[5].n_chars == len(out[5].text)
    assert out[99].text is None and out[100].text == "clean 3.0 text"


def test_checksums_of_the_query(docs, ids):
    from pyspark.sql import functions as F

    for r in packing.pack(docs).select("doc_id", "ids", F.crc32("ids").alias("c")).limit(20).collect():
        assert zlib.crc32(r.ids) == r.c

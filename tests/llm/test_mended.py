"""Whole queries on the awkward table, and the limits that cut work into pieces."""

import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from regweave.llm import chat, common, fingerprints, jaccard_join, mixing, sharding, substrings, token_counts, tokens


@pytest.mark.parametrize("size", [1, 2_000, 1 << 28])
def test_token_counts_of_files_cut_by_bytes(spark, docs, empty, monkeypatch, size):
    monkeypatch.setattr(token_counts, "FILE_BYTES", size)
    monkeypatch.setattr(token_counts, "table", lambda *_: docs)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = Counter((r.doc_id, len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    got = token_counts.op1_count_tokens(spark, "")
    assert Counter((r.doc_id, r.n_tokens) for r in got.collect()) == want
    assert token_counts.docs_per_file(empty) == token_counts.FILE_DOCS if size > 1 << 20 else 1


def test_rendered_blocks_are_the_rendered_text(spark):
    rows = [(1, 0, "assistant", "hi"), (1, 1, "user", "ok"), (1, None, "user", "ok"), (1, None, "user", "ok"), (1, None, "user", "ok"),
            (2, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "user", None), (2, 2, "tool", "c"), (2, 3, "assistant", "d"),
            (3, 5, None, ""), (None, None, "system", "s"), (None, 2, "assistant", "x")]
    turns = spark.createDataFrame([(*r, "more", 3) for r in rows], "conv_id long, turn long, role string, text string, part string, n int")
    whole = {r.conv_id: r.text for r in chat.rendered(chat.repaired(turns)).collect()}
    assert whole[1].startswith("<|user|>\n<|end|>\n<|assistant|>\nhi<|end|>\n")  # an answer stays one
    assert whole[1].count("ok") == 4 and whole[2] == "<|user|>\na\n<|end|>\n<|assistant|>\nd<|end|>\n".replace("a\n<", "a\n\nc<")
    for span, limit in ((1024, 4096), (2, 1), (1, 1)):
        blocks = defaultdict(list)
        for r in chat.rendered_blocks(turns, span=span, limit=limit).collect():
            blocks[r.conv_id].append((r.block, r.text, r.turns, r.copies))
        assert sum(c for own in blocks.values() for *_, c in own) == len(rows)
        for conv, own in blocks.items():
            own.sort()
            assert [k for k, *_ in own] == list(range(len(own)))
            text = "".join(x for _, x, *_ in own)
            roles = re.findall(r"<\|(system|user|assistant)\|>", text)
            assert text.endswith(chat.END) and text.count(chat.END) == len(roles)
            assert sorted(re.findall(r"\w+", text)) == sorted(re.findall(r"\w+", whole[conv]))
        if span == 2:
            assert len(blocks[2]) > 1


def test_keep_one_keeps_every_column(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text, 11, "a", b"x", 1.5, "h", 0), (2, text, 12, "b", b"y", 2.5, "i", 0), (None, "x", 13, None, b"z", 3.5, "j", 0)]
    names = ["doc_id", "text", "_row", "_key", "_id", "row", "held", "id"]
    table = spark.createDataFrame(rows, "doc_id long, text string, _row long, _key string, _id binary, row double, held string, id int")
    kept = jaccard_join.keep_one(table)
    assert kept.columns == names and sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[2]], key=str)


def test_signatures_never_differ_by_more_than_sets():
    rng = np.random.default_rng(4)
    for n in (1, 5, 60, 3000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 63, n // 9 + 1).astype(np.uint64)]))
        bits = sum(int(x ^ y).bit_count() for x, y in zip(*(jaccard_join.signature(s).view(np.uint64).tolist() for s in (a, b))))
        assert bits <= len(np.setxor1d(a, b))


def test_shingles_of_rare_words_come_first():
    words = {w: c for w, c in zip("abcdefgh", (500, 400, 300, 200, 4, 3, 2, 1))}
    hashes = {w: int(jaccard_join._words_of([w])[1][0]) for w in words}
    counts = jaccard_join._Counts(np.array(list(hashes.values()), dtype=np.uint64), np.array(list(words.values())))
    order = jaccard_join._Order(jaccard_join._Counts(np.zeros(0, np.uint64), np.zeros(0, np.int64)), counts)
    (own, often, steps), = order.sets(["a b c d e f g h"], 2)
    prefix, _, _ = order.prefix(own, often, steps, 50)
    rare = jaccard_join.shingle_sets(["g h"], 2)[0][0]
    assert prefix[0] == rare and not often.any()


def test_slots_are_made_by_many_tasks(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 4)
    monkeypatch.setattr(mixing, "PAGE", 8)
    monkeypatch.setattr(mixing, "PAGES", 2)
    slots = mixing.plan(mixing.written(mixing.rows_of(docs), "t"), 5).slots
    pages = slots.select("sid", F.floor(F.col("slot") / 1)).count() / 8
    used = slots.select(F.spark_partition_id().alias("p")).distinct().count()
    assert used > pages / 2 / 3
    names = mixing.mixed(docs.withColumnsRenamed({"row": "held", "m": "shard", "part": "slot", "data": "key1", "g": "first"}), 5)
    assert {"held", "shard", "slot", "key1", "first"} <= set(names.columns)
    assert {(r.held, r.shard, r.slot, r.key1, r.first) for r in names.select("held", "shard", "slot", "key1", "first").collect()} == {("r", "m", 8, "d", 4)}


def test_fingerprint_ranges_look_at_their_own_cut(spark, docs, monkeypatch):
    whole = {(r.doc_id, r.text) for r in docs.collect()}
    want = None
    for rows in (500, 3, 1):
        monkeypatch.setattr(fingerprints, "RANGE_ROWS", rows)
        places = fingerprints.beside_next(docs).collect()
        assert {(r.doc_id, r.text) for r in places if not r.copy} == {(d, t or "") for d, t in whole}
        monkeypatch.setattr(fingerprints, "table", lambda *_: docs)
        got = Counter((r.doc_id, r.edited_sha256) for r in fingerprints.op5_fingerprint_documents(spark, "").collect())
        want = want or got
        assert got == want


def test_shard_loads_are_near_equal(spark, monkeypatch):
    rng = np.random.default_rng(5)
    texts = ["x" * int(n) for n in rng.integers(0, 3000, 600)] + ["same"] * 200 + ["y" * 40_000, None]
    table = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, own string").repartition(4)
    monkeypatch.setattr(sharding, "table", lambda *_: table)
    rows = sharding.op4_shard_documents(spark, "").collect()
    assert Counter(r.doc_id for r in rows) == Counter(range(len(texts)))
    assert all(r.size == len(texts[r.doc_id] or "") + 16 and r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in rows)
    loads = [sum(r.size for r in rows if r.shard == s) for s in range(40)]
    biggest = max(200 * 20, 40_016)  # the groups of equal texts
    assert max(loads) <= max(sum(loads) / 40 + 3_016, biggest) and {r.law for r in rows} == {"bytes"}
    assert len({r.shard for r in rows if texts[r.doc_id] == "same"}) == 1
    for s in range(40):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_pipeline_on_awkward_and_empty_tables(spark, docs, empty, tmp_path):
    docs.write.parquet(str(tmp_path / "a" / "documents.parquet"))
    empty.write.parquet(str(tmp_path / "b" / "documents.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path / "a")).collect()
    known = {r.doc_id for r in docs.collect()}
    assert rows and {r.doc_id for r in rows} <= known
    assert all(r.length == len(r.ids) // 4 for r in rows)
    assert corpus_pipeline.run(spark, str(tmp_path / "b")).collect() == []


def test_passing_tables_go(spark, docs):
    with common.passing_tables(spark):
        path = common.written(docs.select("doc_id"), "gone").inputFiles()[0]
        assert spark.read.parquet(path).count() >= 0
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_marked_texts_are_all_that_is_asked_for(spark, docs):
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    wanted = keyed.where("doc_id % 3 = 0").select("key")
    marks = common.marks_of(wanted)
    assert len(marks) == common.MARKS // 8
    keys = {r.key for r in wanted.collect()}
    assert sum(bin(b).count("1") for b in marks) == len({k & (common.MARKS - 1) for k in keys})
    got = common.packed(keyed, "key", marks=marks)
    assert Counter(r.key for r in got.collect()) == Counter(r.key for r in keyed.collect() if r.key in keys)
    assert common.packed(keyed, "key", marks=common.marks_of(wanted.limit(0))).count() == 0
    assert common.packed(keyed, "key").count() == keyed.count()


def test_repeats_of_homes_are_those_of_all_strings():
    rng = random.Random(3)
    passage = bytes(rng.choices(b"ab ", k=700))
    texts = [bytes(rng.choices(b"ab ", k=300)) + passage[k:] + b"\0" * (k % 3) for k in range(0, 700, 25)] + [b"x" * 450, b"xy", b""]
    strings = Counter(t[k:k + 200] for t in texts for k in range(len(t) - 199))
    # Contexts around every tenth byte; of each text, one stretch with all of them.
    members = [[{"at": p + 5, "g": k, "c": p, "n": 1 + (p == 40)} for p in range(0, len(t) - 32, 10)] for k, t in enumerate(texts)]
    rows = [(k // 4, k, 5, t, m) for k, (t, m) in enumerate(zip(texts, members)) if m]
    kinds = [*substrings._SENT_KINDS[:5]]
    batch = pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*rows), kinds)], substrings._SENT[:5])
    want = {}
    for k, t in enumerate(texts):
        for p in range(0, len(t) - 32, 10):
            hit = [q for q in range(max(0, p - 168), min(p, len(t) - 200) + 1) if strings[t[q:q + 200]] > 1]
            if hit and p != 40:
                want[k, p] = ([hit[0] - p], [hit[-1] + 200 - p])
    calls = Counter()

    def count(frame, event, arg):
        calls[event] += 1

    sys.setprofile(count)
    try:
        got = list(substrings._sort_homes(iter([batch.slice(0, 9), batch.slice(9, 0), batch.slice(9)])))
    finally:
        sys.setprofile(None)
    assert {(r["g"], r["c"]): (r["lo"], r["hi"]) for b in got for r in b.to_pylist()} == want
    # Contexts are worked on together: calls don't go with their number.
    many = [(0, 0, 0, passage, [{"at": 100 + k % 300, "g": k, "c": k, "n": 1} for k in range(20_000)])]
    batch = pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*many), kinds)], substrings._SENT[:5])
    calls.clear()
    sys.setprofile(count)
    try:
        assert sum(b.num_rows for b in substrings._sort_homes(iter([batch]))) == 0
    finally:
        sys.setprofile(None)
    assert calls["call"] + calls["c_call"] < 10_000


def test_homes_are_sorted_whole(monkeypatch):
    rng = random.Random(4)
    same = bytes(rng.choices(b"abcd", k=250))
    rows = [(home, home * 10 + k, 0, same + bytes(rng.choices(b"efgh", k=30)), [{"at": 20, "g": home, "c": home * 10 + k, "n": 1}]) for home in range(7) for k in range(2 + home % 3)]
    kinds = [*substrings._SENT_KINDS[:5]]
    batch = pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*rows), kinds)], substrings._SENT[:5])
    for size in (1, 400, 900, 1 << 20):
        monkeypatch.setattr(substrings, "BATCH_BYTES", size)
        for step in (1, 2, 5, 100):
            cut = [batch.slice(k, step) for k in range(0, batch.num_rows, step)]
            got = [r for b in substrings._sort_homes(iter(cut)) for r in b.to_pylist()]
            assert sorted(r["c"] for r in got) == [r[1] for r in rows]


def test_python_tasks_get_batches_of_few_bytes(spark, docs):
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(size, None)
    rows = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x y "), 2_500).alias("text"))

    def most():
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

        return max(r.n for r in rows.mapInArrow(run, "n long").collect())

    try:
        for stage in (lambda: jaccard_join.join(docs), lambda: corpus_pipeline.keep_good(spark, docs, "")):
            spark.conf.unset(size)
            assert most() > 4 * common.BATCH_BYTES
            stage()
            assert most() < 2 * common.BATCH_BYTES
        spark.conf.set(size, "1234567")  # a session's own size stays
        corpus_pipeline.keep_good(spark, docs, "")
        assert spark.conf.get(size).rstrip("b") == "1234567"
    finally:
        spark.conf.unset(size) if before is None else spark.conf.set(size, before)


def test_remembered_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY_PIECES", 500)
    texts = [[f"n{k}x{j} and {j}z{k}" for j in range(100)] for k in range(20)]
    few = tokens.Encoder(tokens.default_vocabulary(), 0)
    for part in texts:
        ids, bounds = few.batch(part)
        want, where = tokens.Encoder(tokens.default_vocabulary(), 0).batch(part)
        assert ids.tolist() == want.tolist() and bounds.tolist() == where.tolist()
        assert len(few._pieces) <= 500 + 300

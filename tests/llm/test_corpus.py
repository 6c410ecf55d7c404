"""Operators over whole tables, against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from regweave.llm import chat, fingerprints, jaccard_join, mixing, sharding, substrings
from regweave.llm.suffix_array import DEPTH, repeated_places, suffix_array

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_schedule_is_longest_first():
    assert sharding.schedule([7, 5, 4, 3, 3, 2], 2) == [0, 1, 1, 0, 1, 0]


@pytest.mark.parametrize("bucket", [20_000, 5])
def test_shards(spark, docs, empty, monkeypatch, bucket):
    from pyspark.sql import functions as F

    monkeypatch.setattr(sharding, "BUCKET", bucket)
    monkeypatch.setattr(sharding, "CHUNK", 2)
    rows = docs.select(F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key"), F.lit(7).cast("long").alias("size"), "doc_id")
    out = sharding.shard_rows(rows, 3).collect()
    assert len(out) == docs.count()
    groups, shards = defaultdict(set), defaultdict(list)
    for r in out:
        groups[bytes(r.key)].add(r.shard)
        shards[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    sizes = sorted(len(s) for s in shards.values())
    assert sizes[-1] - sizes[0] <= 3
    none = sharding.shard_rows(rows.limit(0), 3)
    assert none.count() == 0


def test_mix_meets_targets_and_caps(docs, empty, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 4)
    monkeypatch.setattr(mixing, "CHUNK", 7)
    mix = mixing.plan(mixing.written(mixing.rows_of(docs), "t"), 5)
    rows = mixing.taken(mix).collect()
    assert len(rows) == docs.count() and rows and sorted(rows) == sorted(mixing.taken(mix).collect())
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r.sid].append(r)
    for own in by.values():
        assert sum(r.size for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= 3 * mixing.BLOCK
    assert abs(sum(o[0].target for o in by.values()) - 1.5 * sum(r.size for r in rows)) < 1e-6
    slots = mix.slots.collect()
    assert sorted(s.slot for s in slots) == list(range(len(slots)))
    assert max(Counter((s.sid, s.block) for s in slots).values()) <= 2
    mixed = mixing.mixed(docs, 5)
    assert mixed.columns == docs.columns
    assert sum(len(WORDS.findall(r.text)) for r in mixed.collect()) == sum(r.taken for r in rows)
    assert mixing.taken(mixing.plan(mixing.rows_of(empty))).count() == 0 and mixing.mixed(empty).count() == 0


def test_mix_is_dealt_to_shards(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 4)
    mix = mixing.plan(mixing.written(mixing.rows_of(docs), "t"), 5)
    rows = mixing.taken(mix).collect()
    assert all(sum(p.words for p in r.places) == r.taken and r.places == sorted(r.places) for r in rows)
    got, sizes = {}, Counter()
    for r in rows:
        for p in r.places:
            assert got.setdefault(p.slot, (p.shard, r.sid)) == (p.shard, r.sid)
            sizes[p.slot] += p.words
    slots = {s.slot: (s.shard, s.sid) for s in mix.slots.collect()}
    assert got == slots and max(sizes.values()) == 4
    size, of = -(-len(slots) // 5), Counter(sid for _, sid in slots.values())
    counts = Counter(got.values())
    for shard in range(5):
        total = sum(n for (k, _), n in counts.items() if k == shard)
        assert total == min(size, len(slots) - shard * size)
        for sid, n in of.items():  # a draw without putting back, in five standard deviations
            share = n / len(slots)
            assert abs(counts[shard, sid] - total * share) <= 5 * (total * share * (1 - share)) ** 0.5 + 1
    assert any(counts[0, sid] != counts[1, sid] for sid in of)
    path = mixing.written(mixing.dealt(docs, 5), "dealt").inputFiles()
    order = [(r._shard, r._slot) for f in sorted(path) for r in spark.read.parquet(f).collect()]
    assert order == sorted(order) and set(order) == {(k, s) for s, (k, _) in slots.items()}
    texts = [r.text for r in mixing.dealt(docs, 5).collect()]
    assert [r.text for r in mixing.mixed(docs, 5).collect()] == texts
    monkeypatch.setattr(mixing, "table", lambda *_: docs)
    assert mixing.op9_mix_sources(spark, "").select("places.shard").count() == docs.count()


def shingles(text, size):
    words = WORDS.findall(text or "")
    return frozenset(tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()


def test_fingerprints_meet_the_next_document(docs, empty, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 4)
    monkeypatch.setattr(fingerprints, "table", lambda *_: docs)
    rows = fingerprints.op5_fingerprint_documents(None, "").collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}
    ids = sorted(texts)
    twice = {8, 13}
    for r in rows:
        if r.doc_id is None or r.doc_id in twice or r.doc_id + 1 in twice or r.doc_id == ids[-1]:
            continue
        own, after = texts[r.doc_id], texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        cut = len(own) // 4
        edited = own[:len(own) - cut] + after[:cut]
        a, b, c = shingles(own, 5), shingles(edited, 5), shingles(after, 5)
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        tolerance = 1e-9 if max(len(a), len(b), len(c)) <= fingerprints.K / 2 else 0.15
        assert r.n_chars == len(own)
        assert abs(r.near_edited - like(a, b)) <= tolerance and abs(r.near_next - like(a, c)) <= tolerance
        assert abs(r.distinct_shingles - len(a)) <= 0.25 * len(a)
    monkeypatch.setattr(fingerprints, "table", lambda *_: empty)
    assert fingerprints.op5_fingerprint_documents(None, "").count() == 0


def test_fingerprints_merge(spark):
    rng = random.Random(2)
    words = ["w%d" % rng.randrange(10**6) for _ in range(900)]
    rows = [(k % 2, " ".join(words[a:a + 50])) for k, a in enumerate(range(0, 850, 25))]
    table = spark.createDataFrame(rows, "k int, text string")
    parts = fingerprints.with_fingerprints(table, f="text")
    merged = {r.k: list(r.f) for r in fingerprints.merge_rows(parts, "k", "f").collect()}
    for k in (0, 1):
        every = set().union(*(r.f for r in parts.where(f"k = {k}").collect()))
        assert merged[k] == sorted(every)[:fingerprints.K]


def brute_components(texts, size, percent):
    sets = {k: shingles("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""), size) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(s), find(k)) for k, s in sets.items()}


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (2, 50)])
def test_join_against_all_pairs(docs, size, percent):
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    want = brute_components(texts, size, percent)
    rows = jaccard_join.join(docs, size=size, percent=percent).collect()
    assert len(rows) == docs.count()
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in rows if r.doc_id is not None)


def test_join_in_a_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HUB_TEXTS", 3)
    monkeypatch.setattr(jaccard_join, "OFTEN", 3)
    rng = random.Random(4)
    base = ["w%d" % k for k in range(60)]
    texts = {}
    for k in range(70):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = "e%d" % rng.randrange(8)
        texts[k] = " ".join(words[rng.randint(0, 3):])
    rows = jaccard_join.join(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), size=3, percent=80).collect()
    want = brute_components(texts, 3, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want


def test_keep_one_of_each_group(docs, empty):
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 10 not in ids and 8 in ids and 2 in ids
    assert jaccard_join.keep_one(empty).count() == 0


def test_keep_one_counts_rows_that_share_an_id(spark):
    base = ["w%d" % k for k in range(80)]
    edited = lambda k: " ".join(base[:k] + ["edit"] + base[k + 1:])
    a, b, c = " ".join(base), "unlike all others in the table", "two rows and no id"
    rows = [
        (1, a), (1, a), (1, a), (2, a), (None, a), (None, edited(40)), (None, edited(20)), (2, b),
        (None, c), (None, c), (3, "one"), (3, "two"), (3, None), (3, None), (None, " "), (None, " "),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    kept = Counter((r.doc_id, r.text) for r in jaccard_join.keep_one(table).collect())
    assert kept == Counter([(1, a), (2, b), (None, c), (3, "one"), (3, "two"), (3, None), (3, None), (None, " "), (None, " ")])
    found = jaccard_join.join(table, size=5, percent=80).collect()
    assert len(found) == len(rows)
    assert Counter(r.component_id for r in found if r.doc_id is None) == Counter({1: 3, None: 4})


def test_suffix_arrays():
    import numpy as np

    rng = random.Random(1)
    for _ in range(150):
        letters = rng.choice([b"ab", b"abc\0", b"a", bytes(range(256))])
        raw = bytes(rng.choice(letters) for _ in range(rng.randint(0, 250))) + b"\0"
        order = suffix_array(np.frombuffer(raw, dtype=np.uint8)).tolist()
        assert sorted(order) == list(range(len(raw)))
        keys = [raw[i:i + DEPTH].ljust(DEPTH, b"\0") for i in order]
        assert keys == sorted(keys)
    one = bytes(rng.choice(b"abc") for _ in range(300))
    assert [h.sum() for h in repeated_places([one, one[:250]], [(0, 0), (0, 0)])] == [0, 0]  # one place, twice
    assert [h.sum() for h in repeated_places([one, one[:250]], [(0, 0), (1, 0)])] == [51, 51]


def brute_cut(texts):
    count = Counter(t[i:i + DEPTH] for t in texts for i in range(len(t) - DEPTH + 1))
    out = []
    for t in texts:
        spans = []
        for i in range(len(t) - DEPTH + 1):
            if count[t[i:i + DEPTH]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + DEPTH
                else:
                    spans.append([i, i + DEPTH])
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + t[at:a], b
        kept += t[at:]
        out.append((len(t), len(t) - len(kept), len(spans), kept))
    return out


@pytest.mark.parametrize("crowd", [10_000, 1])
def test_repeats_are_removed(docs, empty, monkeypatch, crowd):
    monkeypatch.setattr(substrings, "HOME_CONTEXTS", crowd)
    rows = docs.collect()
    want = Counter((r.doc_id, *c) for r, c in zip(rows, brute_cut([(r.text or "").encode() for r in rows])))
    got = substrings.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want
    if crowd > 1:
        assert substrings.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("crowd", [10_000, 1])
def test_repeats_of_rows_that_share_an_id(spark, monkeypatch, crowd):
    monkeypatch.setattr(substrings, "HOME_CONTEXTS", crowd)
    rng = random.Random(8)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    heads, copy = [some(260) for _ in range(3)], some(300)
    rows = [(None, heads[0] + some(700)) for _ in range(2)] + [(7, heads[1] + some(700)) for _ in range(2)]
    rows += [(7, heads[2] + some(400)), (None, heads[2] + some(400))] + [(None, copy)] * 3 + [(None, some(500))]
    want = Counter((i, *c) for (i, _), c in zip(rows, brute_cut([t.encode() for _, t in rows])))
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want
    assert sum(r.n_removed > 0 for r in got) == 9


def brute_cost(roles):
    least = [10**9]

    def go(i, state, cost):
        if cost >= least[0]:
            return
        if i == len(roles):
            least[0] = cost
            return
        for via, more in [(state, 0)] + [(x, chat.INSERT) for x in chat.NEXT[state]]:
            for to in range(3):
                label = chat.GUESS if roles[i] is None else 0 if roles[i] == to else chat.RELABEL
                if to in chat.NEXT[via]:
                    go(i + 1, to, cost + more + label)
                if to == state == via:
                    go(i + 1, to, cost + label + chat.MERGE)

    go(0, chat.START, 0)
    return least[0]


def test_chats_are_repaired_at_least_cost(spark):
    rng = random.Random(2)
    rows = [
        (c if c else None, t if rng.random() < 0.9 else None, rng.choice(["system", "user", "assistant", None, "tool", "User "]), f"x{rng.random():.3f}")
        for c in range(40) for t in range(rng.randint(1, 6))
    ]
    rows += rows[:5]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    costs = []
    for span, limit in ((1024, 4096), (2, 1)):
        got, cost = chat.repaired(table, span=span, limit=limit).collect(), defaultdict(int)
        assert sum(r.copies for r in got) == len(rows)
        turns = defaultdict(list)
        for r in got:
            given = chat.role_number(r.role)
            cost[r.conv_id] += chat.GUESS if given is None else 0 if chat.ROLES[given] == r.new_role else chat.RELABEL
            cost[r.conv_id] += (chat.MERGE if r.action == "merge" else 0) + (chat.INSERT if r.inserted else 0)
            turns[r.conv_id].append(((1 << 62) if r.turn is None else r.turn, r.tie, given))
        costs.append(dict(cost))
    assert costs[0] == costs[1]
    for conv, own in list(turns.items())[:25]:
        assert brute_cost([g for _, _, g in sorted(own, key=lambda x: x[:2])]) == costs[0][conv]
    tags = {0: "S", 1: "U", 2: "A"}
    for r in chat.rendered(chat.repaired(table)).collect():
        roles = "".join(tags[chat.ROLES.index(x)] for x in re.findall(r"<\|(system|user|assistant)\|>", r.text))
        assert re.fullmatch("S?(UA)*U?", roles) and r.text.endswith(chat.END)
    assert chat.repaired(table.limit(0)).count() == 0

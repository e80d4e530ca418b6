"""Exact top-k, SimHash, substring dedup and decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from llm_text import sentence

from statlake.llm import decontam, simhash, substring, topk

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_top_k_by_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(900)]
    same = [0.5] * 8
    vectors += [(1000 + i, same) for i in range(400)]
    odd = [(2000, None), (2001, []), (2002, [None] * 8), (2003, [float("nan")] * 8), (2004, [float("inf")] * 8), (None, same), (2020, [1.0, 2.0]), (2021, [1.0, 1.0]), (2040, [])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors + odd], "vec_id bigint, embedding array<float>, v string, rank int")
    got = sorted(tuple(r) for r in topk.top_k(frame).collect())
    ids = np.array([i for i, _ in vectors])
    x = np.floor(64 * np.array([np.float32(v) for _, v in vectors], float))
    expected = []
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        order = [j for j in np.lexsort((ids, -scores)) if j != i][:20]
        expected += [(int(ids[i]), k + 1, int(ids[j]), int(scores[j])) for k, j in enumerate(order)]
    expected += [(2020, 1, 2021, 64 * 64 + 128 * 64), (2040, 1, 2001, 0)]
    assert got == sorted(expected)
    assert topk.top_k(frame.limit(0)).count() == 0


def test_rows_meet_only_the_query_blocks_that_visit_them(spark, monkeypatch):
    """Far groups of directions, small blocks: a row enters once for each block that visits its annulus."""
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 16)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 500)
    rng = np.random.default_rng(4)
    middles = rng.normal(0, 1, (20, 16))
    vectors = [(i, (middles[i % 19] + rng.normal(0, 0.01, 16)).tolist()) for i in range(9000)]
    table = topk.quantised(spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")).persist()
    index = topk.Index(table, 16, 9000, table.agg({"norm2": "max"}).first()[0])
    queries = topk._query_blocks(index, table.filter("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "v", "norm2"))
    sizes = [r["count"] for r in queries.groupBy("block").count().collect()]
    assert len(sizes) > 1 and sum(sizes) == 450
    visits = topk._visit(index, queries.selectExpr("*", "double(null) AS least"), 20, True).persist()
    parts = spark.createDataFrame([(int(a), -(-int(n) // 500)) for a, n in zip(index.annuli, index.counts)], "annulus int, parts int")
    count = dict(zip(index.annuli.tolist(), index.counts.tolist()))
    expected = sum(count[r["annulus"]] for r in visits.select("annulus", "block").distinct().collect())
    assert topk._meeting_rows(index, visits, parts).count() == expected < 9000 * len(sizes)


def _fingerprint(text):
    import xxhash

    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(prints):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_near_duplicates_by_brute_force(spark, odd_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    prints = [_fingerprint(t) for _, t in rows]
    roots = _components(prints)
    ids = {}
    for (doc_id, _), root in zip(rows, roots):
        if doc_id is not None:
            ids[root] = min(doc_id, ids.get(root, doc_id))
    expected = sorted(((i, f"{p:016x}", ids.get(r)) for (i, _), p, r in zip(rows, prints, roots)), key=str)
    got = sorted((tuple(r) for r in simhash.near_duplicates(odd_documents).collect()), key=str)
    assert got == expected
    assert simhash.near_duplicates(odd_documents.limit(0)).count() == 0
    kept = simhash.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    assert kept.count() == len(set(roots))


@pytest.mark.parametrize("near, block_rows", [(20, simhash.BLOCK_ROWS), (3000, simhash.BLOCK_ROWS), (3000, 90)])
def test_tree_links_connect_what_brute_force_connects(spark, near, block_rows):
    """A dense ball of near copies beside scattered values; small shards, so that borders are crossed.

    With blocks of 90 rows the ball's shards are dealt over tasks, every two blocks together.
    """
    rng = random.Random(near)
    centre = rng.getrandbits(64)
    values = {rng.getrandbits(64) for _ in range(1500)}
    for v in list(values)[:200]:
        values.add(v ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    while near:
        values.add(centre ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
        near -= 1
    held = np.array(sorted(values), np.uint64)
    frame = spark.createDataFrame([(int(v),) for v in held.view(np.int64)], "fp bigint")
    shard_rows, simhash.SHARD_ROWS = simhash.SHARD_ROWS, 100
    try:
        found = simhash.components(simhash.near_links(frame, block_rows)).collect()
    finally:
        simhash.SHARD_ROWS = shard_rows
    got = {}
    for r in found:
        got.setdefault(r["root"], set()).add(r["node"])
    parent = {int(v): int(v) for v in held}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for v in held:
        for w in held[np.bitwise_count(held ^ v) <= 3]:
            a, b = find(int(v)), find(int(w))
            parent[max(a, b)] = min(a, b)
    expected = {}
    for v in held:
        expected.setdefault(find(int(v)), set()).add(int(np.array(v).view(np.int64)))
    assert {frozenset(x) for x in got.values()} == {frozenset(x) for x in expected.values() if len(x) > 1}


def test_every_two_rows_of_a_large_shard_meet_and_no_group_is_large(spark):
    rows = [(0, i) for i in range(5)] + [(1, 100 + i) for i in range(1000)]
    dealt = simhash.paired_blocks(spark.createDataFrame(rows, "shard bigint, fp bigint"), 100).collect()
    groups = {}
    for r in dealt:
        groups.setdefault((r["shard"], r["low"], r["high"]), []).append(r["fp"])
    assert sorted(groups[0, 0, 0]) == list(range(5))
    assert all(len(held) == len(set(held)) <= 300 for held in groups.values())
    met = {(a, b) for (shard, _, _), held in groups.items() if shard == 1 for a in held for b in held}
    assert len(met) == 1000 * 1000


def test_one_of_each_by_brute_force(spark, documents, odd_documents):
    """The pipeline's stage: copies with a word changed, chains, a line that many share, rows without id."""
    import corpus_pipeline

    rng = random.Random(31)
    line = sentence(rng, 30)
    rows = []
    for i in range(24):
        words = sentence(rng, 400).split()
        rows.append((300 + i, " ".join(words), "en"))
        for k in range(1 + i % 3):
            words[rng.randrange(400)] = f"other{i}x{k}"
            rows.append((400 + 3 * i + k, " ".join(words), "en"))
    rows += [(700 + i, f"{sentence(rng, 10 + i)} {line}", "en") for i in range(30)]
    docs = odd_documents.unionByName(documents(rows))
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    prints = [simhash.fingerprint(t.encode() if t is not None else None) for _, t in plain]
    root = list(range(len(plain)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3 and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    best = {}
    for r, (doc_id, _) in zip(root, plain):
        best.setdefault(r, []).append(doc_id)
    expected = [min((i for i in ids if i is not None), default=None) for ids in best.values()]
    kept = corpus_pipeline.one_of_each(spark, docs, "")
    assert sorted([r["doc_id"] for r in kept.collect()], key=str) == sorted(expected, key=str)
    assert kept.columns == docs.columns
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def _removed(rows, width=50):
    first = {}
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - width + 1):
            if doc_id is not None:
                key = tuple(words[i : i + width])
                first[key] = min(doc_id, first.get(key, doc_id))
    out = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            if doc_id is not None and first[tuple(words[i : i + width])] < doc_id:
                gone[i : i + width] = [True] * width
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("group_rows", [20_000, 7])
def test_repeats_by_brute_force(spark, documents, odd_documents, group_rows):
    """Planted passages, a word repeated for long, copies; seven rows a group make every anchor hot."""
    rng = random.Random(8)
    passage = sentence(rng, 70)
    rows = [(200 + i, f"{sentence(rng, 20 + i)}  {passage}\n{sentence(rng, 30)}", "en") for i in range(20)]
    rows += [(300, "er " * 200, "en"), (301, "er " * 90 + "x", "en"), (302, sentence(rng, 49), "en"), (303, "a b " * 60, "de")]
    docs = odd_documents.unionByName(documents(rows))
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted((tuple(r) for r in substring.digests(docs, group_rows=group_rows).collect()), key=str)
    assert got == _removed(plain)
    cut = substring.deduplicated(docs, group_rows=group_rows)
    assert cut.columns == docs.columns
    words = sorted(((r["doc_id"], hashlib.sha256(" ".join(WORD.findall(r["text"] or "")).encode()).hexdigest()) for r in cut.collect()), key=str)
    assert words == sorted(((i, h) for i, _, _, h in got), key=str)


def test_cut_keeps_the_rest_as_it_is():
    text = b" a b\nc  d e\n"
    assert substring.cut(text, [{"start": 1, "stop": 3}]) == b" a d e\n"
    assert substring.cut(text, [{"start": 0, "stop": 5}]) == b""
    assert substring.cut(text, []) == text
    assert substring.digests is not None


def test_repeats_of_empty_table(spark, documents):
    assert substring.digests(documents([])).count() == 0


def test_decontamination_finds_planted_items(spark, documents):
    rng = random.Random(12)
    items = [(i, sentence(rng, 12 + 3 * i) + ". " + sentence(rng, 8) + ".") for i in range(20)]
    benchmark = spark.createDataFrame([*[(i, t, 1) for i, t in items], (50, None, 1), (51, "", 1), (None, sentence(rng, 40), 1), (3, items[3][1], 1)], "item_id bigint, text string, doc_id int")
    rows = [(i, sentence(rng, 150), "en") for i in range(200)]
    planted = {}
    for i, (item, text) in enumerate(items):
        words = text.split()
        if i % 3 == 1:  # a paraphrase: every sixth word another one
            words = [sentence(rng, 1) if j % 6 == 5 else w for j, w in enumerate(words)]
        around = sentence(rng, 5 + 7 * i)
        rows.append((1000 + i, f"{around} {' '.join(words).upper() if i % 5 == 0 else ' '.join(words)} {sentence(rng, 60)}", "en"))
        planted[1000 + i] = item
    rows += [(2000, None, None), (2001, "", None), (None, items[2][1], None)]
    found = decontam.contaminated(documents(rows), benchmark).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert got >= set(planted.items()) | {(None, 2)}
    assert {d for d, _ in got} <= {*planted, None}
    docs = documents(rows)
    left = decontam.clean(docs, benchmark)
    assert left.columns == docs.columns and left.count() == len(rows) - len(planted) - 1
    assert decontam.contaminated(documents([]), benchmark).count() == 0
    assert decontam.contaminated(docs, benchmark.limit(0)).count() == 0
    assert decontam.clean(docs, benchmark.limit(0)).count() == len(rows)


def test_decontamination_finds_paraphrases_at_every_offset(spark, documents):
    """Half of the words with the answer, and 0.7 without it, at all 16 places of a block pair."""
    rng = random.Random(77)
    items = [(i, sentence(rng, 11 + 4 * (i % 12)) + ". " + sentence(rng, 5 + i % 4) + ".") for i in range(560)]
    rows, expected = [], set()
    for item in range(24):
        words = items[item][1].split()
        n, answer = len(words), 5 + item % 4
        for offset in range(16):
            half = offset % 2 == item // 12
            spared = set(range(n - answer, n)) if half else set()
            least = -(-n * (5 if half else 7) // 10)
            free = [j for j in range(n) if j not in spared]
            kept = spared | set(rng.sample(free, max(0, least - len(spared))))
            text = [w if j in kept else f"other{rng.randrange(500)}" for j, w in enumerate(words)]
            doc = 1000 * item + offset
            rows.append((doc, f"{sentence(rng, 32 + offset)} {' '.join(text)} {sentence(rng, 40)}", "en"))
            expected.add((doc, item))
    rows += [(100_000 + i, sentence(rng, 120), "en") for i in range(300)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(documents(rows), benchmark).collect()}
    assert not expected - got, (len(expected - got), len(expected), sorted(expected - got)[:10])
    assert not {d for d, _ in got if d >= 100_000}


def _bare(word):
    return word.strip(b".,;:!?\"'()[]") or word


def test_term_hashes_follow_the_bare_words():
    """Equal hashes for equal bare words only, whatever stands around them and whichever text they are in."""
    rng = random.Random(3)
    texts = [b"", b" \n\t ", b"(a) 'a' a. ... . \xc3\xa9t\xc3\xa9, ab ba", b"x" * 5000, b"!?", b"a\x00b a b"]
    texts += [" ".join(rng.choice("(,'") * rng.randrange(2) + sentence(rng, 1) + rng.choice(".,)") * rng.randrange(3) for _ in range(200)).encode() for _ in range(20)]
    seen, back = {}, {}
    for text, held in zip(texts, decontam.terms(texts)):
        words = [_bare(w) for w in text.split()]
        assert len(held) == len(words)
        assert held.tolist() == decontam.terms([b"pad " + text])[0].tolist()[1:]
        for word, h in zip(words, held.tolist()):
            assert seen.setdefault(word, h) == h and back.setdefault(h, word) == word


def test_tokens_of_odd_rows(spark, odd_documents):
    """Blocks far smaller than the long texts; each row has the terms of its own text."""
    rows = {(r["doc_id"], r["version"]): np.frombuffer(r["terms"], np.uint32).tolist() for r in decontam.tokens(odd_documents, 64).collect()}
    texts = [(r["doc_id"], r["v"], (r["t"] or "").encode()) for r in odd_documents.selectExpr("doc_id", "xxhash64(cast(text as binary)) AS v", "lower(text) AS t").collect()]
    for (doc_id, version, _), held in zip(texts, decontam.terms([t for *_, t in texts])):
        assert rows[doc_id, version] == held.tolist()


def test_found_documents_are_those_of_plain_comparison(spark, documents, monkeypatch):
    """Longest common subsequences of all document and item pairs, over windows at every word."""
    monkeypatch.setattr(decontam, "SEARCH_ITEMS", 7)
    monkeypatch.setattr(decontam, "PRODUCTS", 3)
    rng = random.Random(21)
    items = [(i, sentence(rng, 16 + 2 * i) + ". " + sentence(rng, 6) + ".") for i in range(16)]
    rows = []
    for i in range(160):
        words = items[i % 16][1].split()
        kept = rng.sample(range(len(words)), int(len(words) * (0.2 + 0.8 * (i // 16) / 9)))
        text = [w if j in kept else sentence(rng, 1) for j, w in enumerate(words)]
        rows.append((i, f"{sentence(rng, i % 23)} {' '.join(text)} {sentence(rng, 30)}", "en"))
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(documents(rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    found = decontam.items([(i, t.lower()) for i, t in items])
    for doc_id, text, _ in rows:
        held = decontam.terms([text.lower().encode()])[0]
        for item in found:
            share = max(decontam.common_length(item.terms, held[a : a + 2 * len(item.terms)]) for a in range(0, max(1, len(held) - len(item.terms)))) / len(item.terms)
            answer = decontam.common_length(item.answer, held) >= 0.8 * len(item.answer)
            if share >= 0.7 or share >= 0.5 and answer:
                assert (doc_id, item.item_id) in got, (doc_id, item.item_id, share)
            elif share < 0.5:
                assert (doc_id, item.item_id) not in got


def test_common_subsequence():
    a, b = np.array([1, 2, 3, 4, 2]), np.array([2, 9, 3, 2])
    assert decontam.common_length(a, b) == 3
    assert decontam.common_length(a, np.array([], int)) == 0

"""WARC round trips, packing and the pipeline."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_text import labels_frame, sentence

from statlake.llm import packing, warc


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id bigint, url string, html string, digest string, payload int")


def test_archives_give_back_every_record(spark, tmp_path):
    rng = random.Random(3)
    big = sentence(rng, 400) + "é\r\n\r\nWARC/1.1\r\n" + "ß" * 300_000
    same = sentence(rng, 400)
    rows = [(1, "http://a/1", same), (2, "http://a/2", same), (9, None, same), (3, "u\nv", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (7, "u", big), (8, "u", big), (None, "u", same), (9, None, same)]
    pages = _pages(spark, rows)
    got = sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=str)
    expected = []
    for i, _, html in rows:
        raw = (html or "").encode()
        best = max((j for j, _, h in rows if j is not None and h == html), default=None)
        revisit = len(raw) >= 1000 and i is not None and i < best
        expected.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", best if revisit else None))
    assert got == sorted(expected, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0

    manifest = warc.write(warc.chunks(warc.decide(pages), 1000), str(tmp_path / "out"), roll_bytes=1)
    read = warc.read(manifest, chunk_bytes=999)
    parts = read.filter("page_id = 8").orderBy("chunk_no").collect()
    assert len(parts) > 100 and b"".join(bytes(p["chunk"]) for p in parts).decode() == big
    running = hashlib.sha1()
    for p in parts:
        running.update(bytes(p["chunk"]))
        assert p["digest_so_far"] == running.hexdigest()


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(5)
    for lengths in (rng.integers(1, 4097, 3000), rng.integers(1, 60, 5000), np.full(100, 1366), rng.choice([4000, 96, 48, 2048, 1], 500)):
        counts = np.bincount(lengths, minlength=4097)
        used, sequences = Counter(), 0
        for pattern, times in packing.plan(counts):
            assert sum(l * n for l, n in pattern.items()) <= 4096
            sequences += times
            for l, n in pattern.items():
                used[l] += n * times
        assert used == Counter(lengths.tolist())
        if len(set(lengths.tolist())) > 5:
            assert sequences <= 1.015 * -(-int(lengths.sum()) // 4096)


def test_pieces_of_whole_texts(spark, odd_documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    tokenizer.encode_special_tokens = True
    expected = []
    for r in odd_documents.collect():
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        for piece, at in enumerate(range(0, len(ids), 512)):
            part = ids[at : at + 512]
            expected.append((r["doc_id"], piece, at, len(part), zlib.crc32(part.tobytes())))
    rows = packing.pack(odd_documents, capacity=512).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(expected, key=str)
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 512
    assert packing.pack(odd_documents.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["İstanbul ΣΑΣ ﬁ é don't I'LL 1234 a--b ...", "<|endoftext|> x", "a b c\x1cd", "Ärger. Straße, ß"])
def test_words_give_the_ids_of_the_text(text):
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    encoder = packing.Encoder(path)
    got = np.frombuffer(next(encoder.encode([text.encode()])), "<u4").tolist()
    assert got == tokenizer.encode(text, add_special_tokens=False).ids


def test_pipeline_stages_on_odd_rows(spark, odd_documents, documents, tmp_path):
    import corpus_pipeline

    rng = random.Random(2)
    item = sentence(rng, 40)
    passage = sentence(rng, 60)
    rows = [(500 + i, sentence(rng, 60) + (" you scum" if i % 2 else ""), "en") for i in range(60)]
    rows += [(700, item + " " + sentence(rng, 20), "en"), (701, sentence(rng, 30) + " " + passage, "en"), (702, sentence(rng, 25) + " " + passage, "en")]
    docs = odd_documents.unionByName(documents(rows))
    labels_frame(spark, [(500 + i, 1, i % 2) for i in range(60)]).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    held = {}
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        assert current.columns == docs.columns and current.dtypes == docs.dtypes
        held[name] = {r["doc_id"]: r for r in current.collect()}
    toxic = {500 + i for i in range(1, 60, 2)}
    assert not toxic & held["toxicity"].keys() and {500 + i for i in range(0, 60, 2)} <= held["toxicity"].keys()
    assert {0, 100} <= held["simhash_near_dedup"].keys() and not {101, 102, 105} & held["simhash_near_dedup"].keys()
    assert passage in held["substring_dedup"][701]["text"] and passage not in held["substring_dedup"][702]["text"]
    assert held["substring_dedup"][702]["n_chars"] == len(held["substring_dedup"][702]["text"])
    assert 700 in held["substring_dedup"] and 700 not in held["benchmark_decontamination"]
    assert held["substring_dedup"].keys() - held["benchmark_decontamination"].keys() == {700}
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.collect()} == held["benchmark_decontamination"].keys()


def test_pipeline_on_empty_tables(spark, odd_documents, documents, tmp_path):
    """No documents give no pieces; without labels and benchmark items every component keeps one document."""
    import corpus_pipeline

    labels_frame(spark, []).write.parquet(str(tmp_path / "none/labels.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "none/benchmark.parquet"))
    documents([]).write.parquet(str(tmp_path / "none/documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    odd_documents.write.parquet(str(tmp_path / "some/documents.parquet"))
    labels_frame(spark, []).write.parquet(str(tmp_path / "some/labels.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "some/benchmark.parquet"))
    left = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path / "some")).collect()}
    assert set(range(2, 40)) <= left and 105 not in left

"""Quality, toxicity, language and language-model scores."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_text import labels_frame, sentence

from statlake.llm import language, lm, quality, toxicity


def test_every_odd_row_is_scored(spark, odd_documents):
    labels = labels_frame(spark, [(i, i % 3 > 0, i % 4 == 0) for i in range(40)] + [(None, 1, 1), (3, None, None), (5, 1, 1), (5, 1, 1)])
    n = odd_documents.count()
    for result in (quality.classify(odd_documents, labels), toxicity.classify(odd_documents, labels)):
        rows = result.collect()
        assert len(rows) == n
        assert all(0 <= r["score"] <= 1 for r in rows)
        assert all(r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


@pytest.mark.parametrize("operator, column", [(quality, "quality"), (toxicity, "toxic")])
def test_empty_tables_and_one_class(spark, documents, operator, column):
    none = documents([])
    labels = labels_frame(spark, [])
    assert operator.classify(none, labels).count() == 0
    some = documents([(1, "a b c", "en"), (2, None, None)])
    assert operator.classify(some, labels).count() == 2
    one = labels_frame(spark, [(i, 1, 1) for i in range(9)])
    assert {r["predicted"] for r in operator.classify(some, one).collect()} == {1}


def test_quality_finds_repetition(spark, documents):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        good = i % 3 > 0
        text = sentence(rng, 120) if good else " ".join(w for w in sentence(rng, 12).split() for _ in range(10))
        rows.append((i, text, "en"))
        labels.append((i, good, 0))
    found = {r["doc_id"]: r for r in quality.classify(documents(rows), labels_frame(spark, labels)).collect()}
    held = [i for i in found if found[i]["held_out"]]
    assert sum(found[i]["predicted"] == (i % 3 > 0) for i in held) >= 0.95 * len(held)


def test_naming_a_group_moves_no_score(spark, documents):
    """Identity terms stand in most toxic rows; the penalty keeps neutral mentions clean."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = sentence(rng, 30).split()
        words += (["scum"] if toxic else []) + (["muslims"] if toxic or i % 50 == 1 else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words), "en"))
        labels.append((i, 1, toxic))
    learn = toxicity.labelled(documents(rows), labels_frame(spark, labels), "toxic")
    fair, plain = toxicity.fit(learn), toxicity.fit(learn, penalty=0.0)
    neutral = toxicity._present(b"the muslims met them", toxicity.WordCache(fair.columns))
    insult = toxicity._present(b"you scum", toxicity.WordCache(fair.columns))
    assert fair.score(neutral) < 0.5 < fair.score(insult)
    before = toxicity._present(b"the muslims met them", toxicity.WordCache(plain.columns))
    assert fair.score(neutral) < plain.score(before)


def test_language_of_each_byte_and_text(spark, documents):
    rng = random.Random(6)
    rows = [(i, sentence(rng, 40, "en" if i % 2 else "de"), "en" if i % 2 else "de") for i in range(240)]
    docs = documents([*rows, (900, None, "en"), (901, "123 ...", "de"), (None, "schung", None), (902, "", None)])
    found = {r["doc_id"]: r for r in language.identify(docs, epochs=8).collect()}
    assert found[900]["lang_pred"] == found[901]["lang_pred"] == found[902]["lang_pred"] == "und"
    held = [i for i, _, _ in rows if found[i]["held_out"]]
    assert sum(found[i]["lang_pred"] == ("en" if i % 2 else "de") for i in held) >= 0.95 * len(held)
    net = language.fit(docs, epochs=4)
    text = rows[1][1].encode()
    spans = language.spans(net, text)
    assert spans[0][0] == 0 and spans[-1][1] == len(text) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert language.identify(documents([])).count() == 0
    assert {r["lang_pred"] for r in language.identify(documents([(1, "a", None)])).collect()} == {"und"}


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, (6, 3)).astype(np.uint8)
    n = language.HIDDEN
    for backward in (False, True):
        cell = language.Cell(rng.standard_normal((3 * n, 256)), rng.standard_normal((3 * n, n)))
        slope = rng.standard_normal((6, n, 3))

        def loss():
            return float((language.forward(cell, data, None, backward)[0].astype(float) * slope).sum())

        _, steps = language.forward(cell, data, None, backward, keep=True)
        table, state = language._backward(cell, data, steps, slope, backward)
        for array, gradient, place in ((cell.state, state, (3, 2)), (cell.state, state, (n + 1, 0)), (cell.table, table, (2 * n, int(data[2, 1])))):
            held = array[place]
            array[place] = held + 1e-2
            up = loss()
            array[place] = held - 1e-2
            down = loss()
            array[place] = held
            assert (up - down) / 2e-2 == pytest.approx(gradient[place], rel=0.05, abs=0.02)


def test_base_scores_by_brute_force(spark, odd_documents):
    rows = {(r["doc_id"], r["n_tokens"], round(r["base_score"], 6)): r for r in lm.score(odd_documents).collect()}
    texts = [(r["doc_id"], (r["text"] or "").encode().lower().split() + [b""]) for r in odd_documents.collect()]
    counts = Counter()
    for doc_id, words in texts:
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    for doc_id, words in texts:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        found = [r for (i, k, b), r in rows.items() if i == doc_id and k == len(words) and abs(b - base) < 1e-5 * abs(base) + 1e-6]
        assert found and found[0]["train_tokens"] == n and found[0]["n_known"] == sum(counts[w] > 0 for w in words)
        assert found[0]["score"] < 0
    assert lm.score(odd_documents.limit(0)).count() == 0


def test_block_words_and_endings_by_brute_force(spark, odd_documents):
    """Small groups, few endings held, several blocks in a task: the sums are those of all learning documents."""
    anchors = [b"", b"the", b"der", b"word5x5", b"(the)"]
    rows = [(r["text"], i % 3, i % 5 != 0) for i, r in enumerate(odd_documents.collect())]
    dealt = spark.createDataFrame(rows, "text string, block int, learn boolean").selectExpr("block", "learn", "cast(text as binary) text")
    words, pairs = {}, Counter()
    for text, block, learn in rows:
        found = lm.tokens((text or "").encode())
        for i, word in enumerate(found):
            words[block, word] = words.get((block, word), 0) + learn
            if learn and word not in anchors:
                core = word.strip(lm._EDGE) or word
                for other in found[max(0, i - 4) : i] + found[i + 1 : i + 5]:
                    if other in anchors:
                        pairs.update((key, other) for key in {core[-1:], core[-2:], core[-3:]})
    found = lm.block_words(dealt.coalesce(1), anchors, 500, 20)
    got = {(r[0], bytes(r[1])): r[2] for r in found.filter("block is not null").groupBy("block", "word").sum("n").collect()}
    assert got == words
    names, counts = lm.known_endings(found.filter("block is null").selectExpr("word key", "near data"), 1)
    assert names == sorted({key for key, _ in pairs})
    assert {(names[i], anchors[j]): n for (i, j), n in np.ndenumerate(counts) if n} == pairs


def test_known_endings_are_bounded_by_their_share(spark):
    rows = [(b"a", [900.0]), (b"b", [100.0]), (b"xa", [899.0]), (b"ya", [1.0]), (b"zb", [100.0])] * 2
    near = spark.createDataFrame([(k, np.array(v, np.float32).tobytes()) for k, v in rows], "key binary, data binary")
    assert lm.known_endings(near, 1, 1000)[0] == [b"a", b"b", b"xa", b"ya", b"zb"]
    names, counts = lm.known_endings(near, 1, 100)
    assert names == [b"a", b"b", b"xa", b"zb"] and counts[:, 0].tolist() == [1800, 200, 1798, 200]
    assert lm.known_endings(near.limit(0))[0] == []


def test_token_probabilities_sum_to_one(spark, odd_documents):
    rows = odd_documents.filter("doc_id < 40").selectExpr("doc_id", "cast(text as binary) text")
    words = Counter(w for r in rows.collect() for w in lm.tokens(bytes(r["text"])))
    counts = spark.createDataFrame([(w, n) for w, n in words.items()], "word binary, n bigint")
    stretches = lm.sample_stretches(rows)
    found = lm.block_words(rows.selectExpr("1 block", "true learn", "text"), sorted({w for s in stretches for w in s})[:30])
    near = found.filter("block is null").selectExpr("word key", "near data")
    model = lm.start_model(stretches, counts, near, head=20, classes=5)
    symbols = np.arange(model.symbols)
    context = np.array([model.symbols, 3, 1, 2], np.int32)
    total = 0.0
    for s in symbols:
        chance = 10 ** model.log10(np.r_[context, s].astype(np.int32), np.array([4]))[0]
        own = [w for w in words if model.names.of(w) == s]
        inside = 1.0 if s < len(model.names.head) else sum(words[w] + 1 for w in own) / 10 ** model.class_total[s] + 10 ** -model.class_total[s]
        total += chance * inside
    assert total == pytest.approx(1.0, abs=1e-4)


def test_clashing_labels_count_as_one(spark):
    from statlake.llm.common import marks

    rows = [(1, 0, 1), (1, 1, 0), (2, 0, 0), (2, 0, 0), (3, 7, None), (3, 0, 1), (None, 1, 1), (4, None, 1)]
    for n in (1, 5):
        found = {r["doc_id"]: r["label"] for r in marks(labels_frame(spark, rows).repartition(n), "quality").collect()}
        assert found == {i: label for i, label in {1: 1, 2: 0, 3: 0}.items() if zlib.crc32(str(i).encode()) % 5}


def test_discriminant_by_brute_force(spark, documents):
    """Scores from covariances and inverses written out, without moments or factors."""
    rng = random.Random(8)
    rows = [(i, sentence(rng, 20 + i % 60) if i % 3 else " ".join([sentence(rng, 4)] * 9), "en") for i in range(200)]
    found = {r["doc_id"]: r["score"] for r in quality.classify(documents(rows), labels_frame(spark, [(i, i % 3 > 0, 0) for i in range(200)])).collect()}
    x = {i: np.array(quality.statistics(t.encode())) for i, t, _ in rows}
    learn = [i for i in x if zlib.crc32(str(i).encode()) % 5]
    every = np.array([x[i] for i in learn])
    centre, scale = every.mean(0), np.sqrt(np.maximum(every.var(0), 1e-6))
    groups = [np.array([(x[i] - centre) / scale for i in learn if (i % 3 > 0) == k]) for k in (0, 1)]
    own = [np.cov(g.T, bias=True) for g in groups]
    pooled = sum(len(g) * c for g, c in zip(groups, own)) / len(learn)

    def density(v, k):
        c = 0.8 * own[k] + 0.2 * pooled
        c = 0.95 * c + 0.05 * np.trace(c) / len(c) * np.eye(len(c)) + 1e-6 * np.eye(len(c))
        d = (v - centre) / scale - groups[k].mean(0)
        return math.log(len(groups[k]) / len(learn)) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * d @ np.linalg.inv(c) @ d

    for i, v in x.items():
        assert found[i] == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, (density(v, 1) - density(v, 0)) / 2)))), abs=1e-6)


def test_toxicity_scores_by_brute_force(spark, documents):
    """A score is the logistic sum of the weights of the features that stand in the text."""
    rng = random.Random(9)
    rows = [(i, sentence(rng, 30) + (" scum. Vermin!" if i % 4 == 0 else ""), "en") for i in range(200)] + [(500, None, "en"), (501, "", "en")]
    docs = documents(rows)
    model = toxicity.fit(toxicity.labelled(docs, labels_frame(spark, [(i, 1, i % 4 == 0) for i in range(200)]), "toxic"))
    for row in toxicity.score(docs, model).collect():
        text = dict((i, t) for i, t, _ in rows)[row["doc_id"]] or ""
        bare = {w.strip(toxicity.PUNCTUATION.decode()) for w in text.lower().split()} - {""}
        names = {w.encode() for w in bare} | {f"{k}^{w[:k]}".encode() for w in bare for k in (4, 5) if len(w) > k}
        z = model.bias + sum(model.weights[i] for name, i in model.features.items() if name in names)
        assert row["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def test_swaps_are_summed_as_single_differences(spark, documents):
    rows = documents([(i, f"the muslims and black cats {i}. jews", "en") for i in range(30)]).selectExpr("doc_id", "cast(text as binary) text", "doc_id % 2 AS label")
    terms = [b"muslims", b"jews", b"black"]
    names = [f for term in terms for f in toxicity.word_features(term)]
    model = toxicity.Model({f: i for i, f in enumerate(names)}, np.zeros(len(names)), 0.0)
    x, y, products, swaps = toxicity._sample(rows, model, terms, 100, {0: 15, 1: 15})
    assert swaps == 30 * 3 * 2 + 3 and products.shape == (len(names),) * 2
    assert np.allclose(products, products.T) and np.linalg.eigvalsh(products).min() > -1e-9
    weights = np.ones(len(names))
    # A term against none changes the score by its features; against another one by the difference.
    sizes = [len(toxicity.word_features(t)) for t in terms]
    least = sum(31 * n * n for n in sizes)
    assert weights @ products @ weights >= least


def test_pooled_languages_by_brute_force():
    """Each byte of each segment through both gated cells, one after the other, in plain numbers."""
    rng = np.random.default_rng(2)
    n = language.HIDDEN
    cells = [language.Cell(rng.standard_normal((3 * n, 256)).astype(np.float32), rng.standard_normal((3 * n, n)).astype(np.float32) * 0.3) for _ in range(2)]
    net = language.Network(["a", "b", "c"], cells, [rng.standard_normal((3, n)).astype(np.float32) for _ in range(2)], rng.standard_normal(3).astype(np.float32))
    texts = [b"x", b"some words " * 20, b"", bytes(range(1, 255)), "äöü ß".encode() * 30]

    def states(cell, data):
        h, out = np.zeros(n), []
        for byte in data:
            x, g = cell.table[:, byte].astype(float), cell.state.astype(float) @ h
            update, reset = (1 / (1 + np.exp(-(x[a : a + n] + g[a : a + n]))) for a in (0, n))
            new = np.tanh(x[2 * n :] + reset * g[2 * n :])
            h = update * h + (1 - update) * new
            out.append(h)
        return out

    for text, got in zip(texts, language.pooled(net, texts)):
        total = np.zeros(3)
        for at in range(0, len(text), language.SEGMENT):
            part = text[at : at + language.SEGMENT]
            for a, b in zip(states(cells[0], part), states(cells[1], part[::-1])[::-1]):
                z = np.exp(net.bias + net.out[0] @ a + net.out[1] @ b)
                total += z / z.sum()
        assert got == pytest.approx(total / len(text) if text else total, abs=1e-4)

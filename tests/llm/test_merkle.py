"""The manifest against a plain tree built in Python."""

import hashlib
import zlib

import pytest

from statlake.llm import merkle


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _tree(nodes):
    """(root, proofs): each proof as (left, right) texts by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            start = at[i] // 8 * 8
            p.append(("".join(nodes[start : at[i]]), "".join(nodes[at[i] + 1 : start + 8])))
            at[i] //= 8
        nodes = [_h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def _expected(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, _leaf(row, row["text"]), row))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: x[:3])
        trees[lang] = _tree([x[2] for x in by_lang[lang]])
    root, over = _tree([trees[lang][0] for lang in langs])
    out = []
    for lang, above in zip(langs, over):
        for (_, _, leaf, row), path in zip(by_lang[lang], trees[lang][1]):
            text = row["text"]
            if row["doc_id"] is not None and text is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            node, proof = _leaf(row, text), [*path, *above]
            for left, right in proof:
                node = _h(left, node, right)
            out.append((row["doc_id"], leaf, trees[lang][0], root, _h(*[a + b for a, b in proof]), node, node == root))
    return sorted(out, key=str)


def _got(docs):
    return sorted((tuple(r) for r in merkle.verified(docs, merkle.every_third_lowered()).collect()), key=str)


def test_manifest_of_odd_rows(odd_documents):
    got = _got(odd_documents)
    assert got == _expected(odd_documents.collect())
    assert _got(odd_documents.limit(0)) == []


@pytest.mark.parametrize("n", [1, 8, 9, 65, 512, 513, 700])
def test_trees_of_many_sizes(documents, n):
    """One language owns most rows; full, just overfull and single runs at stored levels and between."""
    rows = [(i * 3 % 2003, f"Text ÄÖ {i}", "en") for i in range(n)] + [(5000 + i, "X", f"l{i}") for i in range(n % 13)]
    docs = documents(rows)
    assert _got(docs) == _expected(docs.collect())


def test_three_stored_levels(documents, monkeypatch):
    """With two levels a step, 4,200 leaves take four stored levels."""
    monkeypatch.setattr(merkle, "KEPT", 2)
    docs = documents([(i, f"Text {i}", "en") for i in range(4200)])
    assert _got(docs) == _expected(docs.collect())


def test_proof_is_the_siblings(documents):
    docs = documents([(i, f"t{i}", "en") for i in range(10)])
    leaves = docs.select("doc_id", "lang", merkle.row_digest([docs["doc_id"]]).alias("digest"))
    rows = {r["doc_id"]: r for r in merkle.manifest(leaves, "lang", ["doc_id"], ["doc_id"]).collect()}
    own = [rows[i]["leaf"] for i in range(10)]
    assert rows[2]["proof"][0]["left"] == "".join(own[:2]) and rows[2]["proof"][0]["right"] == "".join(own[3:8])
    assert rows[9]["proof"][0]["left"] == own[8] and rows[9]["proof"][1]["right"] == ""

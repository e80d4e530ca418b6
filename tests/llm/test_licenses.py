"""The licence scan against a plain search of every text."""

import random
import re

import pytest
from llm_text import sentence

from statlake.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}


def _words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _plain(rows, templates=licenses.TEMPLATES):
    """Every template at every start: half of its rarest words in place, and its phrases near theirs."""
    texts = [_words(t) for _, t in rows]
    counts = {w: sum(w in set(t) for t in texts) for template in templates for w in template.words}
    out = []
    for (doc_id, _), text in zip(rows, texts):
        places, base_labels, labels, score = [], set(), set(), 0.0
        for template in templates:
            rare = sorted(set(template.words), key=lambda w: (counts[w], w))[: licenses.RARE]
            own = [i for i, w in enumerate(template.words) if w in rare]
            for start in range(-len(template.words), len(text)):
                at = lambda i: text[start + i] if 0 <= start + i < len(text) else None
                agree = sum(at(i) == template.words[i] for i in own)
                if not agree or 2 * agree < len(own):
                    continue
                good = True
                for phrase in template.phrases:
                    first = next(i for i in range(len(template.words)) if template.words[i : i + len(phrase)] == phrase)
                    near = range(start + first - template.slack, start + first + template.slack + 1)
                    good &= any(p >= 0 and tuple(text[p : p + len(phrase)]) == phrase for p in near)
                if good:
                    labels.add(template.label)
                    score = max(score, sum(at(i) == w for i, w in enumerate(template.words)) / len(template.words))
        for label, phrase in BASE.items():
            found = [i for i in range(len(text)) if text[i : i + len(phrase)] == phrase]
            places += found
            base_labels |= {label} if found else set()
        assert base_labels <= labels
        ends = (min(places), max(places)) if places else (None, None)
        out.append((doc_id, len(text), len(places), *ends, ",".join(sorted(base_labels)), ",".join(sorted(labels)), score))
    return sorted(out, key=str)


def _check(docs):
    got = sorted((tuple(r) for r in licenses.report(docs).collect()), key=str)
    assert got == _plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    return got


def test_scan_by_brute_force(documents, odd_documents):
    rng = random.Random(4)
    lines = [
        "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the GNU General Public License, version 3.", "mit-LICENSE mit license MIT/licenses",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the “Software”), to deal in the Software without restriction, including",
        "licensed under the GNU General Public\nLicense, Version 2", "general public license license", "version 2 0",
        "MİT license mïT license MIT Kicense", "apache License (mit) License general-public license",
    ]
    rows = [(200 + i, f"{sentence(rng, i)} {line} {sentence(rng, 3)}", "en") for i in range(3) for line in lines]
    rows += [(300, " ".join(lines), "en"), (301, "MIT License " * 400, "en"), (302, "nc 4 0 by cc", "en"), (303, "License MIT", "en")]
    got = _check(odd_documents.unionByName(documents(rows)))
    found = ",".join(r[6] for r in got)
    assert all(label in found for label in ("apache-2.0", "cc-by-nc-4.0", "gpl-2.0", "gpl-3.0", "mit-text", "mit", "apache", "gpl"))


def test_nothing_to_find(documents, odd_documents):
    _check(documents([(1, "plain words", "en"), (2, None, None), (None, "", "en")]))
    assert _check(odd_documents.limit(0)) == []


def test_a_phrase_must_be_in_its_template(documents):
    wrong = licenses.Template("x", ("a", "b"), (("b", "c"),))
    with pytest.raises(ValueError):
        licenses.scan(documents([(1, "a b", "en")]), [wrong])


def test_native_plan(documents):
    """No Python in the plan."""
    plan = licenses.report(documents([(1, "mit license", "en")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

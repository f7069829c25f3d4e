from __future__ import annotations

import random

from citeloom.llm import licenses

from .edge import ALNUM_WORD, documents, empty, lower, ordered

LINES = [
    (900, "Released under the MIT License."), (901, "MIT license, mit License cc-by CC by"), (902, "gnu general public license " * 3),
    (903, "x " * 500 + "This work is licensed under the GNU General Public License, version 3."),
    (904, "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0."), (905, "GNU general\npublic-LICENSE"),
    (906, "apache licenses, a mit licensed thing"), (907, "permission is hereby granted, free of charge, to any person obtaining a copy "
                                                      "of this software and the associated documentation files"),
    (908, "license version gnu public general 3 under the is work this licensed")]


def brute(text):
    w, places, names = ALNUM_WORD.findall(lower(text)), [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        places += at
        names |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(names))


def test_base_columns_match_brute_force(spark):
    docs = documents(spark, extra=LINES)
    got = licenses.license_digest(docs)
    assert ordered(got.drop("labels", "score", "matches").collect()) == ordered((r.doc_id, *brute(r.text)) for r in docs.collect())


def test_labels_and_scores(spark):
    got = {r.doc_id: r for r in licenses.license_digest(documents(spark, extra=LINES)).collect() if r.doc_id and r.doc_id >= 900}
    assert got[900].labels == "mit" and got[900].score == 1.0
    assert got[903].labels == "gpl,gpl-3.0" and got[903].matches == "gpl-3.0:500"
    assert got[904].labels == "apache,apache-2.0,cc-by,cc-by-nc-4.0"
    assert got[907].labels == "mit" and got[907].score >= 0.6  # a word was added
    assert got[908].labels == "" and got[908].score == 0.0  # the words alone are no licence
    assert got[902].labels == "gpl" and got[902].score == 0.5
    for r in got.values():
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


def test_every_template_and_identifier_is_found_in_prose(spark):
    listed = [*licenses.TEMPLATES, *licenses.spdx_templates()]
    docs = documents(spark, extra=[(2000 + i, f"// some code {i}\n{text.upper() if i % 2 else text}\nand more code") for i, (_, text, _) in enumerate(listed)])
    got = {r.doc_id: r for r in licenses.license_digest(docs).collect()}
    for i, (label, _, _) in enumerate(listed):
        assert label in got[2000 + i].labels.split(","), (label, got[2000 + i])
        assert got[2000 + i].score == 1.0
    assert "lgpl-2.1" not in got[2000 + [x for x, _, _ in listed].index("gpl-3.0")].labels


def anywhere(words, known):
    """Labels of the templates that are accepted at any place at all, each place tried."""
    out = set()
    for t in known:
        for at in range(1 - len(t.words), len(words)):
            low, high = at - licenses.SLIP, at + len(t.words) + licenses.SLIP
            if (all(licenses.phrase_at(words, p, low, high) >= 0 for p in t.phrases)
                    and licenses.aligned(words, t.words, at) >= licenses.ACCEPT):
                out.add(t.label)
    return out


def test_the_index_finds_what_trying_every_place_finds(spark):
    rng = random.Random(3)
    known = licenses.templates()
    rows = []
    for i in range(60):
        words = [w.decode() for w in rng.choice(known).words]
        for _ in range(rng.randint(0, len(words) // 5)):  # changed, missing and added words
            at = rng.randrange(len(words))
            words[at:at + rng.randint(0, 1)] = rng.choice([["changed"], []])
        rows.append((i, " ".join(["before"] * rng.randint(0, 9) + words + ["after"] * 3)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: {m.label for m in r.matches} for r in licenses.scan(docs).collect()}
    want = {i: anywhere(licenses.words_of(text.encode()), known) for i, text in rows}
    assert all(got[i] <= want[i] for i in got)
    assert sum(got[i] == want[i] for i in got) >= 0.9 * len(got)


def test_rare_words_index_the_templates():
    known = licenses.templates()
    counts = {b"the": 1000, b"license": 900, b"public": 800, b"under": 950}
    index, anchors = licenses.rare_index(known, 1000, counts)
    assert b"the" not in index and all(n == min(4, len(set(t.words))) for n, t in zip(anchors, known, strict=True))


def test_empty_table(spark):
    assert licenses.license_digest(empty(spark)).count() == 0

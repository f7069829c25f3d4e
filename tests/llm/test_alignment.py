from __future__ import annotations

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citeloom.llm import alignment

from .edge import documents, empty, ordered, prose

pytestmark = pytest.mark.skipif(not os.path.exists(alignment.TOKENIZERS), reason="no tokenizer files")

TEXTS = ["<|endoftext|> and <s> </s> <unk>", "▁ a piece mark", "two  blanks", " leading", "trailing ", "tab\tand\nline", "<0x41>",
         "日本語のテキスト 😀 é", "a" * 300, "x", "\x00\x7f", "ﬁ ligature ½", "é", "﻿mark", "١٢٣ 123 abc123"]


def brute(rows):
    """(doc_id, ...) by the contract: tokens walked one by one, links counted pair by pair."""
    first, second = alignment.tokenizers()
    (a_encode, a_table), (b_encode, b_table) = first.open(), second.open()
    seen, counts = [], Counter()
    for doc_id, text in rows:
        a = b = []
        if text:
            a, b = a_encode([text])[0], b_encode([text])[0]
            line = (" " + text).encode()
            if b"".join(a_table[t] for t in a) != line or b"".join(b_table[t] for t in b) != line:
                a = b = []
        a_at, b_at, pos = {}, {}, 0
        for ids, table, at in ((a, a_table, a_at), (b, b_table, b_at)):
            pos = 0
            for t in ids:
                pos += len(table[t])
                at[pos] = t
        both = sorted(a_at.keys() & b_at.keys())
        groups, last = [], 0
        for end in both:
            groups.append(",".join(str(a_at[p]) for p in sorted(a_at) if last < p <= end) + "|"
                          + ",".join(str(b_at[p]) for p in sorted(b_at) if last < p <= end))
            last = end
        linked = [(a_at[p], b_at[p]) for p in both]
        counts.update(linked)
        seen.append((doc_id, len(a), len(b), len(groups), linked,
                     hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return ordered((i, na, nb, ng, len(linked), sum(counts[p] == best[p[1]] for p in linked), sum(counts[p] for p in linked), sha)
                   for i, na, nb, ng, linked, sha in seen)


@pytest.mark.parametrize("most", [alignment.FREQUENT, 40, 0])
def test_digest(spark, most):
    """The same whether counts are broadcast, joined, or both."""
    docs = documents(spark, extra=[(100 + i, t) for i, t in enumerate(TEXTS)])
    got = ordered(tuple(r) for r in alignment.alignment_digest(docs, most=most).collect())
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_both_ways_to_read_a_byte_level_vocabulary_agree():
    first, _ = alignment.tokenizers()
    (fast, table), (general, entries) = first.open(), first.open_general()
    rng = random.Random(8)
    texts = TEXTS + [prose(rng, 300) for _ in range(20)] + [" " * 3000, "x" * 5000, "\n \n" * 800, "é" * 2000]
    for begin in range(0, 0x110000, 0x1000):  # every character, between letters, digits, marks and blanks
        texts.append("".join(f"a{c}1{c} {c}!{c}\n" for c in map(chr, range(begin, begin + 0x1000)) if not "\ud800" <= c <= "\udfff"))
    assert fast(texts) == general(texts)
    assert table == entries[:len(table)]


def test_texts_that_do_not_come_back_have_no_tokens(spark):
    docs = documents(spark, rows=["", None, "▁", "a  b", "plain words"])
    got = {r.doc_id: r for r in alignment.alignment_digest(docs).collect()}
    for i in (0, 1, 2):
        assert tuple(got[i])[1:] == (0, 0, 0, 0, 0, 0, "")
    assert got[4].n_groups > 0
    assert alignment.alignment_digest(empty(spark)).count() == 0


def test_groups_and_overlaps(spark):
    docs = documents(spark, extra=[(100 + i, t) for i, t in enumerate(TEXTS)])
    first, second = alignment.tokenizers()
    a_table, b_table = first.open()[1], second.open()[1]
    text_of = defaultdict(set)
    for r in docs.collect():
        text_of[r.doc_id].add(r.text)
    for r in alignment.aligned(docs, first, second).collect():
        if not r.groups:
            assert not r.overlaps
            continue
        line = b"".join(a_table[t] for g in r.groups for t in g.a)
        assert line in {(" " + t).encode() for t in text_of[r.id] if t}
        at = 0
        for g in r.groups:
            assert g.start == at and b"".join(a_table[t] for t in g.a) == b"".join(b_table[t] for t in g.b) == line[g.start:g.end]
            at = g.end
        assert at == len(line)
        spans = []
        for ids, table in (([t for g in r.groups for t in g.a], a_table), ([t for g in r.groups for t in g.b], b_table)):
            ends = np.cumsum([len(table[t]) for t in ids])
            spans.append([(e - len(table[t]), e) for t, e in zip(ids, ends, strict=True)])
        if len(spans[0]) < 400:
            want = [(i, j, x[1] == y[1]) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if x[0] < y[1] and y[0] < x[1]]
            assert [tuple(o) for o in r.overlaps] == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=30), st.randoms())
def test_intervals(a_len, rng):
    total, b_len = sum(a_len), []
    while sum(b_len) < total:
        b_len.append(rng.randint(1, min(5, total - sum(b_len))))
    got = alignment.coalesce(np.array(a_len), np.array(b_len))
    a_end, b_end = np.cumsum(a_len), np.cumsum(b_len)
    both = sorted(set(a_end.tolist()) & set(b_end.tolist()))
    assert got.a_group.tolist() == np.searchsorted(both, a_end).tolist()
    assert got.b_group.tolist() == np.searchsorted(both, b_end).tolist()
    assert sum(got.together) == len(both)


def test_portions_do_not_change_results(spark, monkeypatch):
    rng = random.Random(4)
    docs = documents(spark, rows=["".join(rng.choice("ab cé\n") for _ in range(rng.randint(0, 60))) for _ in range(80)])
    want = ordered(tuple(r) for r in alignment.alignment_digest(docs).collect())
    monkeypatch.setattr(alignment, "PORTION", 50)
    assert ordered(tuple(r) for r in alignment.alignment_digest(docs).collect()) == want

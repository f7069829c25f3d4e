from __future__ import annotations

import random

import numpy as np
import pytest

from citeloom.llm import neardup

from .edge import BLANK_WORD, documents, empty, lower, ordered, prose


def shingles(text):
    w = BLANK_WORD.findall(lower(text))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def groups(rows):
    """The root row of each row's component, by comparing all pairs."""
    sets = [shingles(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    return [find(i) for i in range(len(rows))], sets


def brute(rows):
    """(doc_id, n_shingles, component_id, kept)."""
    root, sets = groups(rows)
    out = []
    for i, r in enumerate(rows):
        ids = [x.doc_id for k, x in enumerate(rows) if root[k] == root[i] and x.doc_id is not None]
        low = (min(ids) if ids else None) if sets[i] else r.doc_id
        out.append((r.doc_id, len(sets[i]), low, low == r.doc_id))
    return ordered(out)


def family(rng, base, copies, changed):
    """Copies of a text with ``changed`` words replaced each: their links form chains and stars."""
    out = []
    for _ in range(copies):
        w = base.split(" ")
        for i in rng.sample(range(len(w)), changed):
            w[i] = f"new{rng.randint(0, 10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_edge_rows(spark):
    docs = documents(spark)
    assert ordered(neardup.neardup_digest(docs).collect()) == brute(docs.collect())


def test_families_near_the_threshold(spark):
    rng = random.Random(5)
    rows = []
    for size, copies, changed in ((60, 12, 1), (60, 12, 2), (200, 25, 4), (200, 25, 6), (30, 10, 1), (8, 8, 1), (400, 15, 8)):
        base = prose(rng, size)
        rows += [base, *family(rng, base, copies, changed)]
    chain = prose(rng, 150).split(" ")
    for step in range(12):  # each near the one before, the ends far apart
        chain = [*chain[5:], *prose(rng, 5).split(" ")]
        rows.append(" ".join(chain))
    rng.shuffle(rows)
    docs = documents(spark, rows=rows)
    assert ordered(neardup.neardup_digest(docs).collect()) == brute(docs.collect())


def test_shared_passages_do_not_link(spark):
    rng = random.Random(6)
    passage = prose(rng, 60)
    docs = documents(spark, rows=[prose(rng, 30) + " " + passage + " " + prose(rng, 30) for _ in range(40)])
    got = neardup.neardup_digest(docs)
    assert ordered(got.collect()) == brute(docs.collect())


def test_later_rounds_compare_what_the_first_one_missed(spark, monkeypatch):
    """One bucket for all documents: blocks and rounds must find every link."""
    monkeypatch.setattr(neardup, "BLOCK", 100)
    monkeypatch.setattr(neardup, "STREAM", 5)
    monkeypatch.setattr(neardup, "DEVIATIONS", 20)  # far more candidates than links
    rng = random.Random(8)
    rows = []
    for _ in range(6):
        base = prose(rng, 80)
        rows += [base, *family(rng, base, 3, 2)]
    docs = documents(spark, rows=rows)
    real = neardup.sketch

    def one_bucket(*args):
        from pyspark.sql import functions as F
        return real(*args).withColumn("bands", F.when(F.col("n_shingles") > 0, F.array(F.lit(1).cast("long"))))

    monkeypatch.setattr(neardup, "sketch", one_bucket)
    assert ordered(neardup.neardup_digest(docs).collect()) == brute(docs.collect())


def test_hot_groups_of_copies(spark):
    rng = random.Random(9)
    base = prose(rng, 90)
    docs = documents(spark, rows=[base] * 300 + family(rng, base, 60, 2) + [prose(rng, 50) for _ in range(20)])
    assert ordered(neardup.neardup_digest(docs).collect()) == brute(docs.collect())


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    kept = neardup.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    rows, got = docs.collect(), kept.collect()
    root, sets = groups(rows)
    want = {x for x, s in zip(root, sets, strict=True) if s}
    assert len([r for r in got if shingles(r.text)]) == len(want)
    assert len([r for r in got if not shingles(r.text)]) == len([s for s in sets if not s])


def test_empty_table(spark):
    assert neardup.neardup_digest(empty(spark)).count() == 0
    assert neardup.keep_one(empty(spark)).count() == 0


def test_registers_hold_leading_zeros_and_mantissa():
    rng = np.random.default_rng(1)
    s = np.unique(rng.integers(0, 2 ** 63, 5000, dtype=np.uint64) * np.uint64(2))
    regs = neardup.registers(s)
    for bucket in range(neardup.BUCKETS):
        least = min(int(x) & (2 ** 57 - 1) for x in s if int(x) >> 57 == bucket)
        bits = format(least, "057b")
        zeros = len(bits) - len(bits.lstrip("0"))
        assert regs[bucket] >> 10 == zeros
        assert abs(int(regs[bucket] & 1023) - int(bits[zeros + 1:zeros + 11].ljust(10, "0"), 2)) <= 1


@pytest.mark.parametrize("same", [0, 500, 1500, 1900])
def test_estimates_are_close(same):
    rng = np.random.default_rng(same)
    pool = rng.integers(0, 2 ** 63, 4000, dtype=np.uint64) * np.uint64(2)
    a, b = np.unique(pool[:2000]), np.unique(np.concatenate([pool[:same], pool[2000:4000 - same]]))
    jaccard = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    got = neardup.estimate(neardup.registers(a)[None], neardup.registers(b)[None], np.array([len(a)]), np.array([len(b)]))
    assert abs(got[0] - jaccard) < 0.2

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from citeloom.llm import vectors

from .edge import ordered

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, id string, vec string, salt string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "c", "e", "i", "v", "s") for i, v, lab in rows], SCHEMA).repartition(3)


def brute(rows, parts=16, entries=64, rounds=2):
    """The contract in plain Python: every distance to every entry, whole numbers of any size."""
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(good[0][1]) // parts if good else 0
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in good]
    seeds = sorted(range(len(good)), key=lambda r: (good[r][0] is None, good[r][0] or 0))[:entries]
    books = [[list(cut[r][p]) for r in seeds] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            met = defaultdict(list)
            for r in range(len(good)):
                met[near(p, cut[r][p])[1]].append(cut[r][p])
            for n, xs in met.items():
                books[p][n] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    out, by_label = [], defaultdict(int)
    for r, (i, _, lab) in enumerate(good):
        found = [near(p, cut[r][p]) for p in range(parts)]
        out.append((i, "".join(f"{n:02x}" for _, n in found), sum(d for d, _ in found), lab))
        by_label[lab] += out[-1][2]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return ordered((i, c, e, by_label[lab], digest) for i, c, e, lab in out)


def some(n, dims, seed, spread=0.3):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(dims)], rng.choice([None, 1, 2, 3])) for i in range(n)]


@pytest.mark.parametrize("n, dims, spread", [(300, 64, 0.3), (90, 16, 0.01), (40, 32, 5.0)])
def test_digest_against_every_distance(spark, n, dims, spread):
    """Also with fewer vectors than entries, and with many equal entries and distances."""
    rows = some(n, dims, n, spread)
    got = ordered(tuple(r) for r in vectors.code_digest(frame(spark, rows)).collect())
    assert got == brute(rows)


def test_dropped_odd_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = some(80, 32, 5)
    rows += [rows[3], rows[3], (None, rows[4][1], 2), (900, None, 1), (901, [nan, *[0.0] * 31], 1), (902, [inf] * 32, None),
             (903, [None, *[0.0] * 31], 3)]
    got = ordered(tuple(r) for r in vectors.code_digest(frame(spark, rows)).collect())
    assert got == brute(rows)
    other = vectors.code_digest(frame(spark, [*rows, (950, [1.0] * 7, 5), (951, [3e30] * 32, 6), (952, [], 7)]))
    extra = {r.vec_id: (r.code, r.error, r.label_error) for r in other.collect() if r.vec_id in (950, 951, 952)}
    assert extra == dict.fromkeys((950, 951, 952), (None, None, None))


def test_empty_tables(spark):
    assert vectors.code_digest(frame(spark, [])).count() == 0
    assert vectors.code_digest(frame(spark, [(1, None, 1)])).count() == 0


@pytest.mark.parametrize("k", [1, 2, 63, 64, 65, 200])
def test_masks_hold_every_nearest_entry(k):
    rng = np.random.default_rng(k)
    entries = rng.integers(-20, 20, (k, 4))
    x = rng.integers(-40, 40, (500, 4))
    every = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
    search = vectors.SliceSearch(entries)
    entry, far = search.nearest(x)
    assert (far == every.min(axis=1)).all() and (entry == every.argmin(axis=1)).all()
    assert k < 60 or np.bitwise_count(search.candidates(x)).sum() < 0.6 * x.shape[0] * k


def test_codes_decode_near_their_vectors(spark):
    rows = some(400, 32, 9)
    df = frame(spark, rows)
    books = vectors.train(df, parts=16)
    for r in vectors.encode(df, books).limit(20).collect():
        v = np.array(rows[r.vec_id][1])
        apart = 256 * np.abs(np.array(books.decode(r.code)) - v)
        assert (apart ** 2).sum() <= r.error + 2 * apart.sum() + 32

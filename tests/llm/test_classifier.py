from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from citeloom.llm import classifier

from .edge import documents, empty, prose

SF = "/root/testdata/sf0.01"


def conv(text: bytes, net) -> np.ndarray:
    """Chunk responses by their definition, byte by byte."""
    b = classifier.padded(text)
    n = (len(b) - classifier.WIDTH + 1 - classifier.CHUNK) // classifier.STEP + 1
    at = [[sum(net.p["filters"][j][b[i + j]] for j in range(classifier.WIDTH)) + net.p["bias"]
           for i in range(c * classifier.STEP, c * classifier.STEP + classifier.CHUNK)] for c in range(n)]
    return np.array(at).max(axis=1)


@pytest.mark.parametrize("size", [0, 1, 511, 512, 513, 960, 961, 3000])
def test_chunks_cover_the_text_and_responses_match(size):
    text = bytes(random.Random(size).randrange(1, 256) for _ in range(size))
    net = classifier.Network()
    b = classifier.padded(text)
    chunks = (len(b) - classifier.WIDTH + 1 - classifier.CHUNK) // classifier.STEP + 1
    assert bytes(b[:size]) == text and (chunks - 1) * classifier.STEP + classifier.CHUNK >= size
    np.testing.assert_allclose(classifier.chunk_responses(b, net.tables()), conv(text, net), atol=1e-4)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = classifier.Network(filters=3, hidden=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    docs = [classifier.chunks_of(bytes(rng.integers(97, 123, n, dtype=np.uint8))) for n in (100, 1500, 700)]
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        total = 0
        for d, target in zip(docs, y, strict=True):
            v = classifier.document_vector(np.concatenate([classifier.chunk_responses(c, net.tables()) for c in d]).astype(np.float64))
            p = net.head(v)
            total -= target * np.log(p) + (1 - target) * np.log(1 - p)
        return total / len(docs)

    got = net.gradients(docs, y)
    for name in ("w1", "b1", "w2", "b2", "bias"):
        flat = net.p[name].reshape(-1)
        for i in range(min(6, flat.size)):
            keep, step = flat[i], 1e-3
            flat[i] = keep + step
            up = loss()
            flat[i] = keep - step
            down = loss()
            flat[i] = keep
            assert got[name].reshape(-1)[i] == pytest.approx((up - down) / (2 * step), abs=2e-3)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in classifier.quality_scores(docs, labels).collect() if r.held_out and r.doc_id in known]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert sum(r.predicted == known[r.doc_id] for r in rows) / len(rows) > 0.9


def test_edge_rows_and_nothing_to_learn(spark):
    docs = documents(spark)
    rng = random.Random(1)
    labels = spark.createDataFrame([(i, int(rng.random() < 0.5)) for i in range(12)] + [(None, 1), (5, None), (5, 1)],
                                   "doc_id long, quality int")
    got = classifier.quality_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    blank = {r.score for r in got if r.doc_id in (0, 1)}
    assert len(blank) == 1  # null and empty texts
    assert {r.score for r in classifier.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert classifier.quality_scores(empty(spark), labels).count() == 0


def test_held_out_rows_do_not_teach(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, prose(rng, 60)) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    flipped = spark.createDataFrame([(i, (i % 2) ^ int(zlib.crc32(str(i).encode()) % 4 == 2)) for i in range(60)], "doc_id long, quality int")
    a, b = ({r.doc_id: r.score for r in classifier.quality_scores(docs, x).collect()} for x in (labels, flipped))
    assert a == b
    sample, y = classifier.training_sample(docs, labels, rows=10)
    assert len(sample) == len(y) == 10

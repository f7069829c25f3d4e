from __future__ import annotations

import random

import corpus_pipeline

from citeloom.llm import decontam, quality

from .edge import ALNUM_WORD, lower, prose
from .test_neardup import groups, shingles

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark, tmp_path):
    rng = random.Random(12)
    item = prose(rng, 25).replace("\n", " ")
    texts = [prose(rng, rng.randint(60, 200)) for _ in range(30)]
    texts += texts[:6]  # exact copies
    texts += [t.replace(t.split(" ")[20], "swapped", 1) for t in texts[6:9]]  # near copies
    texts += [prose(rng, 60) + " " + item + " " + prose(rng, 60)] * 2  # holds the benchmark item
    texts += ["few words", None, "&&& word### other$$$ " * 60, "a | b | c | d | e | f\n" * 30]
    rows = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, item


def test_stages(spark, tmp_path):
    folder, item = corpus(spark, tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    first = stages["quality rules"](spark, docs, folder).cache()
    assert {r.doc_id for r in first.collect()} == {
        r.doc_id for r in quality.quality_digest(docs).where("kept").collect()}
    second = stages["near-duplicates"](spark, first, folder).cache()
    left = second.collect()
    sets = [shingles(r.text) for r in left]
    for a in range(len(sets)):  # no two that stay are near copies
        for b in range(a):
            both = len(sets[a] & sets[b])
            assert 100 * both < 75 * (len(sets[a]) + len(sets[b]) - both)
    groups_, sets_ = groups(first.collect())
    assert len(left) == len({g for g, s in zip(groups_, sets_, strict=True) if s})
    third = stages["benchmark decontamination"](spark, second, folder).cache()
    words = ALNUM_WORD.findall(lower(item))
    windows = {tuple(words[i:i + 10]) for i in range(len(words) - 9)}
    clean = set()
    for r in left:
        w = ALNUM_WORD.findall(lower(r.text))
        if not any(tuple(w[i:i + 10]) in windows for i in range(len(w))):
            clean.add(r.doc_id)
    assert {r.doc_id for r in third.collect()} == clean and len(clean) < len(left)
    fourth = stages["mixing sources"](spark, third, folder).cache()
    assert fourth.count() > 0 and {r.doc_id for r in fourth.collect()} <= clean
    for stage in (first, second, third, fourth):
        assert stage.columns == docs.columns
    fifth = stages["sharding"](spark, fourth, folder).collect()
    places = {}
    for r in fifth:
        places.setdefault(r.shard, []).append(r.slot)
    assert len(fifth) == fourth.count() and set(places) <= set(range(8))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert decontam.K < decontam.WINDOW


def test_run_writes_and_reads_between_stages(spark, tmp_path, monkeypatch):
    folder, _ = corpus(spark, tmp_path)
    few = [x for x in corpus_pipeline.STAGES if x[0] in ("quality rules", "mixing sources", "sharding")]
    monkeypatch.setattr(corpus_pipeline, "STAGES", few)
    out = corpus_pipeline.run(spark, folder)
    assert out.count() > 0 and {"doc_id", "text", "shard", "slot"} <= set(out.columns)

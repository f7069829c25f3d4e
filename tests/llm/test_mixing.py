from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from citeloom.llm import mixing

from .edge import BLANK_WORD, documents, empty, ordered


def shares(sizes, weights=(5, 2, 1), epochs=3):
    """Targets by sharing the excess again and again, as the rule is stated."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > epochs * sizes[s] + 1e-9]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = float(epochs * sizes[s])
        left -= sum(out[s] for s in over)
        open_ -= set(over)
    return out


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, "c": 5, None: 7}, {"a": 0, "b": 50}, {"é": 3, "z": 900, "A": 4, "b": 1},
    {"only": 12}, {f"s{i:02}": i * i for i in range(20)}])
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(table).collect()}
    assert got == pytest.approx(shares(sizes))


def test_digest(spark):
    docs = documents(spark, extra=[(1000 + i, "a few words here " * (i % 9)) for i in range(400)])
    rows = docs.select("doc_id", "text", "source").collect()
    got = mixing.mixing_digest(docs).collect()
    assert ordered((r.doc_id, r.size) for r in got) == ordered((r.doc_id, len(BLANK_WORD.findall(r.text or ""))) for r in rows)
    sizes, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        n = len(BLANK_WORD.findall(r.text or ""))
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    want = shares(sizes)
    taken, by_target = defaultdict(int), {}
    for r in got:
        taken[r.target] += r.taken
        by_target[r.target] = r.source_size
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    for s, target in want.items():
        key = min(taken, key=lambda x: abs(x - target))
        assert key == pytest.approx(target) and by_target[key] == sizes[s]
        assert abs(taken[key] - target) <= largest[s] / 2 + 1
    assert ordered(mixing.mixing_digest(docs.repartition(7)).collect()) == ordered(got)


@pytest.mark.parametrize("shards", [1, 2, 5, 16])
def test_quotas_are_exact_at_every_shard(spark, shards):
    sizes = [("a", 5000), ("b", 100), ("c", 20000), (None, 3)]
    sources = mixing.targets(spark.createDataFrame(sizes, "source string, source_size long"))
    rows = mixing.shard_quotas(sources, shards=shards, blocks=1000).collect()
    quotas = [[b - a for a, b in zip(r.firsts, [*r.firsts[1:], r.quota], strict=True)] for r in rows]
    assert all(len(q) == shards and min(q) >= 0 for q in quotas)
    totals = [sum(x) for x in zip(*quotas, strict=True)]
    assert max(totals) - min(totals) <= max(1, shards.bit_length())  # halves are rounded at each level
    assert sum(totals) == sum(r.quota for r in rows)


def test_splits_are_hypergeometric(spark):
    """Over many nodes the blocks of a source that go left have the mean and variance of the law."""
    tree = spark.range(400).selectExpr("int(2 * id) as low", "2 as n", "explode(sequence(1L, 100L)) as block").selectExpr(
        "if(block <= 30, 0, 1) as rank", "block", "low", "n")
    rows = mixing._split(tree, 17).groupBy("low").agg(
        F.count("*").alias("all"), F.count(F.when(F.col("rank") == 0, 1)).alias("first")).collect()
    assert len(rows) == 800 and all(r["all"] == 50 for r in rows)
    first = [r["first"] for r in rows if r["low"] % 2 == 0]
    mean = sum(first) / len(first)
    var = sum((x - mean) ** 2 for x in first) / len(first)
    assert abs(mean - 15) < 0.5 and abs(var - 50 * 0.3 * 0.7 * 50 / 99) < 1.5


def test_many_sources(spark):
    sizes = [(f"s{i:05}", 3 + i % 50) for i in range(3000)]
    sources = mixing.targets(spark.createDataFrame(sizes, "source string, source_size long"))
    rows = mixing.shard_quotas(sources, shards=4, blocks=1000).collect()
    assert len(rows) == 3000 and sum(r.quota for r in rows) >= 1000


def test_draws_follow_their_blocks(spark):
    docs = documents(spark, extra=[(1000 + i, "word " * (1 + i % 5)) for i in range(300)])
    rows = (mixing.mix(docs, shards=4).withColumn("draw", F.explode("__mix_.draws")).select("source", "draw.*").collect())
    held = defaultdict(set)
    for r in rows:
        held[r.source, r.block].add(r.shard)
    assert all(len(s) == 1 for s in held.values())  # a block belongs to one shard
    for source in {r.source for r in rows}:  # runs of blocks are disjoint and in order
        shards = [min(held[k]) for k in sorted(k for k in held if k[0] == source)]
        assert shards == sorted(shards)


def test_mixed_rows_and_written_shards(spark, tmp_path):
    docs = documents(spark)
    mixed = mixing.mixed(docs)
    assert mixed.dtypes == docs.dtypes
    words = sum(len(BLANK_WORD.findall(r.text or "")) for r in mixed.collect())
    assert words == sum(r.taken for r in mixing.mixing_digest(docs).collect())
    path = str(tmp_path / "shards")
    mixing.write_shards(docs.select("doc_id", "text", "source"), path)
    assert spark.read.parquet(path).count() == mixed.count()


def test_empty_table(spark):
    assert mixing.mixing_digest(empty(spark)).count() == 0
    assert mixing.mixed(empty(spark)).count() == 0

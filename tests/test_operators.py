"""Operators against brute force: dedupe, dense keys, lookup-or-insert, MERGE."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from citeloom.operators import (assign_keys, bridge_rows, drop_rows, keep_first, lookup_or_insert, merge_last_wins,
                                merge_touched, not_loaded, orphans, repeated_rows, resolve_key)
from citeloom.schemas import DIM_JOURNAL, JOURNAL_QUARTILE, empty_table
from conftest import canon, rows


def _data(spark, n=300, seed=7):
    rnd = random.Random(seed)
    data = [(f"{i:05d}", rnd.choice(["a", "b", "c", None, "hot", "hot", "hot"]), rnd.randint(0, 9)) for i in range(n)]
    return data, spark.createDataFrame(data, "id string, k string, v int")


def test_keep_first_and_last(spark):
    data, df = _data(spark)
    first, last = {}, {}
    for i, k, v in data:
        if k not in first or i < first[k][0]:
            first[k] = (i, k, v)
        if k not in last or i > last[k][0]:
            last[k] = (i, k, v)
    assert rows(keep_first(df, ["k"], ["id"]), "id", "k", "v") == canon(first.values())
    assert rows(keep_first(df, ["k"], ["id"], last=True), "id", "k", "v") == canon(last.values())
    # The same from narrow rows with a row id; equal orders keep the lower id.
    numbered = df.withColumn("row", F.col("id").cast("int")).withColumn("same", F.lit(1))
    for order, want in (("id", first), ("same", first)):
        lost = repeated_rows(numbered, ["k"], [order], "row")
        assert rows(drop_rows(numbered, lost, "row"), "id", "k", "v") == canon(want.values())


def test_repeated_rows_sorts_no_wide_row(spark, tmp_path):
    spark.range(50).selectExpr("id", "repeat(string(id % 7), 1000) as text", "string(id) as o").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = drop_rows(df, repeated_rows(df, ["text"], ["o"], "id"), "id")
    assert out.count() == 7
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate(key=[text" not in plan and "min_by(text" not in plan


def test_keep_first_is_partial_aggregate(spark):
    _, df = _data(spark)
    plan = keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan  # map-side combine: a hot key never reaches one task whole


def test_assign_keys_equals_row_number(spark):
    _, df = _data(spark, n=1000, seed=3)
    got = assign_keys(df.repartition(7), "key", ["id"], start=41, num_partitions=5)
    want = sorted((i + 42, r["id"]) for i, r in enumerate(sorted(df.collect(), key=lambda r: r["id"])))
    assert rows(got, "key", "id") == canon(want)


def test_assign_keys_independent_of_partitioning(spark):
    _, df = _data(spark, n=500, seed=5)
    a = rows(assign_keys(df.repartition(3), "key", ["id"], num_partitions=2), "key", "id")
    b = rows(assign_keys(df.repartition(11), "key", ["id"], num_partitions=9), "key", "id")
    assert a == b


def test_assign_keys_after_existing_table(spark):
    existing = spark.createDataFrame([(7,), (12,)], "key long")
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "id string")
    assert rows(assign_keys(df, "key", ["id"], after=existing), "key", "id") == [(13, "a"), (14, "b"), (15, "c")]
    empty = spark.createDataFrame([], "key long")
    assert rows(assign_keys(df, "key", ["id"], after=empty), "key", "id") == [(1, "a"), (2, "b"), (3, "c")]


def test_assign_keys_empty(spark):
    df = spark.createDataFrame([], "id string")
    assert assign_keys(df, "key", ["id"], start=5).count() == 0


def test_lookup_or_insert_first_writer_wins(spark):
    existing = spark.createDataFrame([(1, "Old", "X", "indexe")], DIM_JOURNAL)
    cands = spark.createDataFrame(
        [("B", "b2", "pas indexe", "002"), ("B", "b1", "indexe", "001"), ("Old", "new", "pas indexe", "000"),
         ("A", "a", "indexe", "003"), (None, "n", "indexe", "004")],
        "journal_main string, issn string, quartils string, load_order string")
    dim, inserted = lookup_or_insert(existing, cands, "journal_main", "journal_id", order_by=["load_order"])
    assert rows(dim) == [(1, "Old", "X", "indexe"), (2, "B", "b1", "indexe"), (3, "A", "a", "indexe")]
    assert inserted.count() == 2


def test_merge_last_wins(spark):
    target = spark.createDataFrame([(1, "2020", "Q3", 7), (2, "2021", "Q2", 7)], JOURNAL_QUARTILE)
    source = spark.createDataFrame(
        [("2020", 7, "Q2", "001", 0), ("2020", 7, "Q1", "002", 0), ("2022", 7, "Q4", "003", 1),
         ("2022", 7, "Q3", "003", 0), ("2019", 8, "Q1", "000", 0)],
        "annee string, id_journal long, quartil string, load_order string, pos int")
    out = merge_last_wins(target, source, ["annee", "id_journal"], ["quartil"], ["load_order", "pos"], "quartil_id")
    assert rows(out) == [(1, "2020", "Q1", 7), (2, "2021", "Q2", 7), (3, "2019", "Q1", 8), (4, "2022", "Q4", 7)]
    again = merge_last_wins(out, source, ["annee", "id_journal"], ["quartil"], ["load_order", "pos"], "quartil_id")
    assert rows(again) == rows(out)  # MERGE twice = once


def test_bridge_and_orphans(spark):
    keyed = spark.createDataFrame([(1, ["A", "B", "A"]), (2, ["B"]), (3, [])], "publication_id long, authors array<string>")
    dim = spark.createDataFrame([(10, "A"), (11, "B")], "author_id long, author_name string")
    bridge = bridge_rows(keyed, "publication_id", "authors", dim, "author_name", "author_id")
    assert rows(bridge) == [(1, 10), (1, 11), (2, 11)]
    bad = orphans(spark.createDataFrame([(1, 10), (1, 99), (2, None)], "p long, a long"), "a", dim, "author_id")
    assert rows(bad) == [(1, 99)]


def test_not_loaded_compares_nulls(spark):
    cur = spark.createDataFrame([("t1", "d1"), ("t2", None)], "title string, doi string")
    new = spark.createDataFrame([("t1", "d1"), ("t2", None), ("t3", "d3")], "title string, doi string")
    assert rows(not_loaded(new, cur, ["title", "doi"])) == [("t3", "d3")]


def test_merge_touched_is_the_merge_of_the_touched_buckets(spark):
    bucket = lambda: F.col("id_journal") % 5
    target = spark.createDataFrame([(i + 1, str(2000 + i % 3), f"Q{i}", i // 3) for i in range(30)], JOURNAL_QUARTILE)
    source = spark.createDataFrame([("2001", "N1", 2, "a", 0), ("2001", "N2", 2, "b", 0), ("1990", "N3", 7, "a", 1)],
                                   "annee string, quartil string, id_journal long, load_order string, pos int")
    args = (["annee", "id_journal"], ["quartil"], ["load_order", "pos"], "quartil_id")
    whole = merge_last_wins(target, source, *args)
    touched = merge_touched(target, source, *args, bucket=bucket)
    assert rows(touched) == rows(whole.where(bucket() == 2))
    assert merge_touched(target, source.limit(0), *args, bucket=bucket).count() == 0


def test_hot_key_not_collected(spark):
    """One key holding most rows still dedupes through partial aggregation."""
    df = spark.range(20000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("id"),
                                   F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    out = keep_first(df, ["k"], ["id"])
    assert out.where("k = 'hot'").collect()[0]["id"] == "000000"
    assert out.count() == 1 + 4000


def test_salted_resolve_key_equals_plain_join(spark):
    facts = spark.range(3000).select(F.col("id").alias("fid"),
                                     F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
                                         (F.col("id") % 50).cast("string")).alias("name"))
    dim = spark.range(50).select(F.col("id").cast("string").alias("name"), (F.col("id") + 100).alias("k")) \
        .unionByName(spark.createDataFrame([("hot", 999)], "name string, k long"))
    plain = resolve_key(facts, dim, "name", "name", "k")
    salted = resolve_key(facts, dim, "name", "name", "k", salt_buckets=8, salt_by="fid")
    assert rows(plain, "fid", "k") == rows(salted, "fid", "k")
    assert salted.count() == 3000

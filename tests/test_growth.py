"""What a load computes, moves and holds as its tables grow."""

from __future__ import annotations

import datetime
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from citeloom.plans import integrity, load_star, split_orphans
from conftest import rows

REFERENCES = {"line": (("k", "parent", "pk"),)}


@pytest.fixture
def small_tasks(spark, monkeypatch):
    monkeypatch.setattr(integrity, "ROWS_PER_TASK", 500, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def lines(spark, n):
    """Rows with two keys each, a hot key, and null keys."""
    k = F.when(F.col("id") % 10 == 0, F.lit(7)).when(F.col("id") % 10 != 1, F.floor(F.col("id") / 2))
    return spark.range(n).select(k.cast("long").alias("k"), F.col("id").alias("v"))


@pytest.mark.parametrize("n", (4000, 16000))
def test_orphan_split_gives_each_task_as_many_rows_at_any_size(spark, small_tasks, n):
    child, parents = lines(spark, n), spark.range(n).where("id % 3 = 1").withColumnRenamed("id", "pk")
    kept, found = split_orphans({"line": child, "parent": parents.where("pk < 1000")},
                                {"parent": parents.where("pk >= 1000")}, REFERENCES)
    everything = child.collect()
    known = [r for r in everything if r["k"] is None or r["k"] % 3 == 1]
    assert rows(kept["line"]) == sorted(((r["k"], r["v"]) for r in known), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert rows(found, "key_value") == sorted((str(r["k"]),) for r in everything if r["k"] is not None and r["k"] % 3 != 1)
    most = kept["line"].groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most < 500 + n / 5  # the hot and the null keys lie in one task each


def test_tables_without_orphans_are_passed_on(spark):
    child, parents = lines(spark, 100), spark.range(100).withColumnRenamed("id", "pk")
    kept, found = split_orphans({"line": child}, {"parent": parents}, REFERENCES)
    assert kept["line"] is child and found.count() == 0


def table_folder(spark, path):
    """A few customers and orders as the entry's queries read them."""
    spark.createDataFrame([(i, f"Customer#{i}", ["FURNITURE", "MACHINERY"][i % 2]) for i in range(3)],
                          "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{path}/customer.parquet")
    day = datetime.datetime(1996, 2, 3)
    spark.createDataFrame([(i, i % 3, "FOP"[i % 3], day, ["1-URGENT", "2-HIGH", "5-LOW"][i % 3 - i % 2]) for i in range(12)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"
                          ).write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_added_facts_and_bridge_are_computed_once(spark, tmp_path):
    load = load_star(entry.order_articles(spark, table_folder(spark, tmp_path / "in")))
    for name in ("fact_publication", "publication_author"):
        plan = load.added(name)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan, name
    for name in ("dim_author", "dim_journal", "dim_date"):  # their size is known, so joins broadcast them, not the facts
        assert "Join" not in load.added(name)._jdf.queryExecution().optimizedPlan().toString(), name
    facts, bridge = load.added("fact_publication"), load.added("publication_author")
    assert rows(facts, "publication_id") == [(i + 1,) for i in range(facts.count())] and facts.count()
    assert rows(bridge.select("publication_id").distinct()) == rows(facts, "publication_id")


@pytest.mark.parametrize("halves", (False, True))
def test_landing_is_compressed_and_the_same_one_written_once(spark, tmp_path, monkeypatch, halves):
    folder, landings = table_folder(spark, tmp_path / "in"), []
    monkeypatch.setattr(entry, "run_batch", lambda spark, landing, *a, **k: landings.append(landing))
    entry._loaded_warehouse(spark, folder, halves)
    assert len(landings) == 2 and len(set(landings)) == (2 if halves else 1)
    for odd, landing in enumerate(landings):
        files = [f for f in os.listdir(landing.removeprefix("file:")) if f.startswith("part-")]
        assert files and all(f.endswith(".gz") for f in files)
        assert rows(spark.read.text(landing)) == rows(entry.order_documents(spark, folder, odd if halves else None))

"""Readers and sinks: whole-file JSON documents, CSV, staging, versioned publish."""

from __future__ import annotations

import json
import threading
import uuid

import pytest

from pyspark.sql import functions as F

from citeloom.plans import load_star, normalize_publications, split_orphans
from citeloom.plans.pipeline import run_batch, stage_clean
from citeloom.schemas import STAR_TABLES, empty_table
from citeloom.sources import (claim_load, create_tables, current_load, explode_users, publish_load, published_loads,
                              read_csv, read_current, read_json_documents, read_publications, read_rejected, release_claim,
                              write_staging)
from citeloom.sources.sinks import CLAIMS, LOADS, bucket_of

READERS = {"users": [{"id": 40 + i, "name": f"reader-{i}", "email": f"r{i}@library.test"} for i in range(2)],
           "settings": {"theme": "sepia", "notifications": False, "language": "fr"},
           "metadata": {"version": "7", "generated_at": "never"}}


def test_multiline_document_and_explode(spark, tmp_path):
    (tmp_path / "readers.json").write_text(json.dumps(READERS, indent=1))
    rows = explode_users(read_json_documents(spark, str(tmp_path / "readers.json"))).collect()
    assert sorted((r["user_pos"], r["user_id"], r["email"], r["theme"], r["language"]) for r in rows) == [
        (0, 40, "r0@library.test", "sepia", "fr"), (1, 41, "r1@library.test", "sepia", "fr")]


def test_csv_with_header(spark, tmp_path):
    (tmp_path / "shelf.csv").write_text('code,title,copies\n7,"Rivers, a history",3\n9,Atlas,\n')
    df = read_csv(spark, str(tmp_path / "shelf.csv"), "code int, title string, copies int")
    assert sorted(tuple(r) for r in df.collect()) == [(7, "Rivers, a history", 3), (9, "Atlas", None)]


def test_object_id_and_staging_overwrite(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps({"_id": {"$oid": "65f0c0ffee"}, "Title": "T", "DOI": "d",
                                                "Authors": ["A"], "Publication Date": "1 May 2020"}) + "\n")
    raw = read_publications(spark, str(landing))
    assert raw.collect()[0]["_id"] == "65f0c0ffee"
    path = str(tmp_path / "staging")
    write_staging(raw, path)
    write_staging(raw, path)  # a rerun replaces the staged rows
    assert spark.read.parquet(path).count() == 1


def landing_of(tmp_path, n=6, extra="not json\n"):
    landing = tmp_path / "landing"
    landing.mkdir()
    docs = [{"_id": str(i), "Title": f"J{i % 2} (P{i})", "DOI": f"d{i}", "Authors": [f"a{i % 3}"],
             "Publication Date": "1 May 2020", "Quartils": [{"année": "2020", "quartil": f"Q{1 + i % 4}"}]}
            for i in range(n)]
    (landing / "a.json").write_text("\n".join(json.dumps(d, ensure_ascii=False) for d in docs) + "\n" + extra)
    return str(landing)


def warehouse(spark, tmp_path):
    return create_tables(spark, "w_" + uuid.uuid4().hex, str(tmp_path / "warehouse"))


def state(spark, wh):
    return {n: sorted(map(str, t.collect())) for n, t in read_current(spark, wh).items()}


def rows_of_load(spark, wh, name, load):
    return spark.table(f"`{wh}`.{name}").where(F.col("load") == load).count()


def test_loads_append(spark, tmp_path):
    landing, wh = landing_of(tmp_path), warehouse(spark, tmp_path)
    assert current_load(spark, wh) is None
    assert all(read_current(spark, wh)[n].count() == 0 for n in STAR_TABLES)
    assert run_batch(spark, landing, wh, version="1") == 1
    first = state(spark, wh)
    assert len(first["fact_publication"]) == 6 and len(first["dim_journal"]) == 2 and len(first["journal_quartile"]) == 2
    rejected = read_rejected(spark, wh, "quarantine_landing").collect()
    assert [(r["value"], r["reject_reason"], r["load"]) for r in rejected] == [("not json", "not_an_object", 1)]
    run_batch(spark, landing, wh, version="2", idempotent=True)
    assert state(spark, wh) == first
    assert rows_of_load(spark, wh, "fact_publication", 2) == 0  # a load writes its own rows only
    run_batch(spark, landing, wh, version="3")
    assert len(state(spark, wh)["fact_publication"]) == 12 and published_loads(spark, wh) == ["1", "2", "3"]
    assert rows_of_load(spark, wh, "fact_publication", 3) == 6


def test_what_became_of_each_record(spark, tmp_path):
    docs = [{"_id": str(i), "Title": f"J{i % 3} (P{i // 2})", "DOI": None if i == 4 else f"d{i}", "Authors": ["a"],
             "Publication Date": "31 February 2020" if i == 6 else "1 May 2020"} for i in range(9)]
    landing, wh, counts = tmp_path / "landing", warehouse(spark, tmp_path), {}
    landing.mkdir()
    (landing / "a.json").write_text("\n".join(map(json.dumps, [*docs, {**docs[2], "_id": "99"}])) + "\nnot json\n[1]\n")
    run_batch(spark, str(landing), wh, version="1", counts=counts)
    assert counts == {"landing": 12, "not_objects": 2, "duplicates": 1, "incomplete": 1, "rejected": 1, "loaded": 7,
                      "already_loaded": 0, "orphans": 0}
    run_batch(spark, str(landing), wh, version="2", idempotent=True, counts=counts)
    assert (counts["loaded"], counts["already_loaded"]) == (0, 7)


def articles_of(spark, landing):
    return normalize_publications(stage_clean(spark, landing))


def half(spark, tmp_path, name, odd):
    """Landing data of half the records; both halves have both journals."""
    folder = tmp_path / name
    folder.mkdir()
    docs = [{"_id": f"{i:03}", "Title": f"J{i // 2 % 2} (P{i})", "DOI": f"d{i}", "Authors": [f"a{i % 3}"],
             "Publication Date": "1 May 2020", "Quartils": [{"année": str(2000 + i), "quartil": "Q1"}]}
            for i in range(12) if i % 2 == odd]
    (folder / "a.json").write_text("\n".join(json.dumps(d, ensure_ascii=False) for d in docs))
    return str(folder)


def keys_are_distinct(spark, wh):
    for name, key in (("fact_publication", "publication_id"), ("dim_journal", "journal_id"), ("dim_author", "author_id"),
                      ("journal_quartile", "quartil_id"), ("dim_date", "date_id")):
        keys = [r[key] for r in read_current(spark, wh)[name].collect()]
        assert sorted(keys) == list(range(1, len(keys) + 1)), name


def test_of_two_loads_from_the_same_start_one_is_refused(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    current = read_current(spark, wh)
    loads = [load_star(articles_of(spark, half(spark, tmp_path, f"half{odd}", odd)), current).build_all(added=True) for odd in (0, 1)]
    added = [{n: t.added(n) for n in t} for t in loads]
    publish_load(added[0], spark, wh, "A", base=current.last)
    before = state(spark, wh)
    with pytest.raises(RuntimeError, match="was computed from load 0"):
        publish_load(added[1], spark, wh, "B", base=current.last)
    assert state(spark, wh) == before
    run_batch(spark, str(tmp_path / "half1"), wh, version="B")
    keys_are_distinct(spark, wh)
    now = read_current(spark, wh)
    assert now["fact_publication"].count() == 12 and now["journal_quartile"].count() == 12
    assert now["dim_journal"].count() == 2


def test_two_loads_at_once(spark, tmp_path):
    """Both begin together: one lands, the other is refused, and lands when it is run again."""
    wh, failed = warehouse(spark, tmp_path), {}
    folders = {v: half(spark, tmp_path, f"half{v}", odd) for odd, v in enumerate("AB")}
    begin = threading.Barrier(2)

    def load(version):
        begin.wait()
        try:
            run_batch(spark, folders[version], wh, version=version)
        except RuntimeError as refused:
            failed[version] = str(refused)

    threads = [threading.Thread(target=load, args=(v,)) for v in folders]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(failed) == 1
    assert len(published_loads(spark, wh)) == 1
    run_batch(spark, folders[next(iter(failed))], wh, version=next(iter(failed)))
    keys_are_distinct(spark, wh)
    assert read_current(spark, wh)["fact_publication"].count() == 12


def test_a_merge_leaves_untouched_buckets_alone(spark, tmp_path):
    """The second load has quartiles of one journal: the other's bucket keeps its file."""
    wh = warehouse(spark, tmp_path)
    run_batch(spark, half(spark, tmp_path, "first", 0), wh, version="1")
    folder = tmp_path / "second"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps({
        "_id": "900", "Title": "J1 (P900)", "DOI": "d900", "Authors": ["a0"], "Publication Date": "1 May 2020",
        "Quartils": [{"année": "2002", "quartil": "Q4"}, {"année": "1990", "quartil": "Q2"}]}, ensure_ascii=False))
    journals = {r["journal_main"]: r["journal_id"] for r in read_current(spark, wh)["dim_journal"].collect()}
    buckets = {name: spark.range(1).select(bucket_of(F.lit(i).cast("long"))).first()[0] for name, i in journals.items()}
    assert buckets["J0"] != buckets["J1"]

    def files():
        rows = spark.table(f"`{wh}`.journal_quartile").select("bucket", "load", F.input_file_name().alias("f")).distinct().collect()
        return {(r["bucket"], r["load"]): r["f"] for r in rows}

    before = files()
    run_batch(spark, str(folder), wh, version="2")
    after = files()
    assert set(after) - set(before) == {(buckets["J1"], 2)} and all(after[k] == f for k, f in before.items())
    got = {(r["id_journal"], r["annee"]): r["quartil"] for r in read_current(spark, wh)["journal_quartile"].collect()}
    assert got[journals["J1"], "2002"] == "Q4" and got[journals["J1"], "1990"] == "Q2" and got[journals["J0"], "2000"] == "Q1"
    keys_are_distinct(spark, wh)


@pytest.mark.parametrize("order, duplicates, incomplete, kept", [("dedupe_first", 2, 1, 2), ("filter_first", 1, 2, 2)])
def test_clean_counts_add_up(spark, tmp_path, order, duplicates, incomplete, kept):
    docs = [("1", "A", "d"), ("2", "A", "d"), ("3", "B", "d"), ("4", "C", None), ("5", "C", None)]
    (tmp_path / "a.json").write_text("\n".join(json.dumps(
        {"_id": i, "Title": t, "DOI": d, "Authors": [], "Publication Date": "1 May 2020"}) for i, t, d in docs))
    counts = {}
    staged = stage_clean(spark, str(tmp_path / "a.json"), order=order, counts=counts)
    assert counts == {"read": 5, "duplicates": duplicates, "incomplete": incomplete, "kept": kept}
    assert staged.count() == kept


def test_a_published_load_is_refused_and_stays(spark, tmp_path):
    landing, wh = landing_of(tmp_path), warehouse(spark, tmp_path)
    run_batch(spark, landing, wh, version="1")
    before = state(spark, wh)
    with pytest.raises(ValueError, match="already published"):
        run_batch(spark, landing, wh, version="1")
    assert state(spark, wh) == before


def test_a_load_that_died_between_tables_is_invisible_and_can_run_again(spark, tmp_path):
    landing, wh = landing_of(tmp_path), warehouse(spark, tmp_path)
    run_batch(spark, landing, wh, version="1")
    before = state(spark, wh)
    some = {"dim_author": spark.createDataFrame([(99, "half written", None, None)], STAR_TABLES["dim_author"])}
    broken = some | {"fact_publication": spark.createDataFrame([(1, "t")], "publication_id long, title string").selectExpr(
        "publication_id", "title", "string(assert_true(publication_id is null)) as doi", "date'2020-01-01' as publication_date",
        "'' as link", "'' as abstract", "1L as journal_id", "'' as quartils")}
    # As a driver that dies would leave it: claimed, some tables written.
    with pytest.raises(Exception):
        publish_load(broken, spark, wh, "2", base=1, parallel=False)
    assert rows_of_load(spark, wh, "dim_author", 2) > 0
    assert state(spark, wh) == before and current_load(spark, wh) == "1"
    for refused in ({"version": "3"}, {"version": "2"}, {"version": "3", "retry": True}):
        with pytest.raises(RuntimeError, match="is claimed by"):
            run_batch(spark, landing, wh, **refused)
    run_batch(spark, landing, wh, version="2", retry=True)
    after = state(spark, wh)
    assert len(after["fact_publication"]) == 12 and after["dim_author"] == before["dim_author"]


def test_a_claim_can_be_given_up(spark, tmp_path):
    landing, wh = landing_of(tmp_path), warehouse(spark, tmp_path)
    assert claim_load(spark, wh, "dead", 0) == 1
    with pytest.raises(RuntimeError, match="dead"):
        claim_load(spark, wh, "1", 0)
    spark.sql(f"INSERT INTO `{wh}`.dim_date PARTITION (load = 1) VALUES (7, date'1999-01-01', 1999, 1, 1)")
    release_claim(spark, wh)
    run_batch(spark, landing, wh, version="1")
    assert [r["year"] for r in read_current(spark, wh)["dim_date"].collect()] == [2020]


def test_a_load_that_raises_gives_its_claim_back(spark, tmp_path):
    landing, wh = landing_of(tmp_path), warehouse(spark, tmp_path)
    with pytest.raises(ValueError, match="unknown order"):
        run_batch(spark, landing, wh, version="1", order="none")
    run_batch(spark, landing, wh, version="2")
    assert published_loads(spark, wh) == ["2"]


def test_another_catalog_attaches_the_files(spark, tmp_path):
    landing, wh = landing_of(tmp_path), warehouse(spark, tmp_path)
    run_batch(spark, landing, wh, version="1")
    other = create_tables(spark, "w_" + uuid.uuid4().hex, str(tmp_path / "warehouse"))
    assert state(spark, other) == state(spark, wh)
    assert [tuple(r) for r in spark.table(f"`{other}`.{LOADS}").collect()] == [("1", 1)]
    run_batch(spark, landing, other, version="2")
    assert len(state(spark, other)["fact_publication"]) == 12
    assert spark.table(f"`{other}`.{CLAIMS}").count() == 2


def test_orphans_go_to_quarantine(spark):
    current = {n: empty_table(spark, n) for n in STAR_TABLES}
    current["dim_author"] = spark.createDataFrame([(1, "a", None, None)], STAR_TABLES["dim_author"])
    rows = {
        "dim_journal": spark.createDataFrame([(5, "J", "i", "f")], STAR_TABLES["dim_journal"]),
        "fact_publication": spark.createDataFrame(
            [(1, "t", "d", None, "l", "a", 5, "q"), (2, "t", "d", None, "l", "a", 6, "q"), (3, "t", "d", None, "l", "a", None, "q")],
            STAR_TABLES["fact_publication"]),
        "publication_author": spark.createDataFrame([(1, 1), (1, 9), (2, 1), (4, 9)], STAR_TABLES["publication_author"])}
    kept, found = split_orphans(rows, current)
    assert sorted(r["publication_id"] for r in kept["fact_publication"].collect()) == [1, 3]
    assert [tuple(r) for r in kept["publication_author"].collect()] == [(1, 1)]
    assert sorted(tuple(r) for r in found.collect()) == [
        ("fact_publication", "journal_id", "6", "no_row_in_dim_journal"),
        ("publication_author", "author_id", "9", "no_row_in_dim_author"),
        ("publication_author", "author_id", "9", "no_row_in_dim_author"),
        ("publication_author", "publication_id", "2", "no_row_in_fact_publication"),
        ("publication_author", "publication_id", "4", "no_row_in_fact_publication")]


def test_typed_rows_equal_their_json_text(spark, tmp_path):
    docs = [{"_id": "1", "Title": "A (j)", "DOI": "d1", "Authors": ["Ann", "Bo"], "Publication Date": "1 May 2020",
             "ISSN": {"Electronic ISSN": "E1"}, "Quartils": [{"année": "2020", "quartil": "Q1"}, {"année": "2021", "quartil": None}]},
            {"_id": "2", "Title": "B (j)", "DOI": "d2", "Authors": None, "Publication Date": "2 May 2020", "ISSN": None,
             "Quartils": []}]
    text = tmp_path / "json"
    text.mkdir()
    (text / "a.json").write_text("\n".join(json.dumps(d, ensure_ascii=False) for d in docs))
    typed = spark.read.schema(
        "_id string, Title string, DOI string, Authors array<string>, `Publication Date` string, "
        "ISSN struct<`Electronic ISSN`:string>, Quartils array<struct<`année`:string,quartil:string>>").json(str(text))
    for fmt in ("parquet", "orc"):
        typed.write.format(fmt).save(str(tmp_path / fmt))
    want, *got = (sorted(map(str, normalize_publications(read_publications(spark, str(tmp_path / f), fmt=f)).collect()))
                  for f in ("json", "parquet", "orc"))
    assert "reject_reason=None" in want[1] and "Ann" in want[0]
    for rows in got:
        assert rows == want


def test_parquet_landing_and_non_null_mode(spark, tmp_path):
    rows_in = [("1", "A (j)", "d1", '["x"]', "1 May 2020"), ("2", "B (j)", None, None, "1 May 2020")]
    df = spark.createDataFrame(rows_in, "_id string, Title string, DOI string, Authors string, `Publication Date` string")
    path = str(tmp_path / "pq")
    df.write.parquet(path)
    present = read_publications(spark, path, fmt="parquet")
    assert [r["__required_reason"] for r in present.orderBy("_id").collect()] == [None, None]
    non_null = read_publications(spark, path, fmt="parquet", required="non_null")
    assert [r["__required_reason"] for r in non_null.orderBy("_id").collect()] == [None, "missing_required_keys"]
    assert set(present.columns) >= {"ISSN", "Quartils", "Link", "abstract", "journal_main"}


def test_producer_to_stream_roundtrip(spark, tmp_path):
    from citeloom.streaming import ingest_sensors, publish_readings, read_sensor_stream
    readings = spark.createDataFrame([(1, 29.411, 50.5, "2024-01-02 03:04:05"), (2, 29.0, 50.0, "2024-01-02 03:04:06")],
                                     "sensor_id int, temperature double, humidity double, timestamp string")
    topic_dir = str(tmp_path / "topic")
    publish_readings(readings, fmt="text", path=topic_dir)
    out = str(tmp_path / "out")
    q = ingest_sensors(read_sensor_stream(spark, fmt="text", path=topic_dir), f"{out}/r", f"{out}/q",
                       checkpoint_location=str(tmp_path / "ck"))
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(f"{out}/r").select("sensor_id", "temperature", "timestamp").collect())
    assert got == [(1, 29.41, "2024-01-02T03:04:05Z"), (2, 29.0, "2024-01-02T03:04:06Z")]


def test_preview_in_load_order(spark):
    from citeloom.plans.pipeline import preview
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "load_order string")
    assert [r["load_order"] for r in preview(df, 2).collect()] == ["a", "b"]

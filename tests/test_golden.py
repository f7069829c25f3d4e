"""Golden publication fixtures, one per behaviour trap, through the whole load."""

from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F

from citeloom.plans import clean_publications, load_star, normalize_publications
from citeloom.sources import read_publications
from conftest import canon


def doc(_id, title, doi="d", authors=("A",), date="1 May 2020", **extra):
    d = {"_id": _id, "Title": title, "DOI": doi, "Authors": list(authors) if isinstance(authors, tuple) else authors,
         "Publication Date": date}
    d.update(extra)
    return d


def write_docs(tmp_path, docs):
    path = tmp_path / f"landing-{uuid.uuid4().hex}"
    path.mkdir()
    with open(path / "part-0.json", "w", encoding="utf-8") as f:
        for d in docs:
            f.write((d if isinstance(d, str) else json.dumps(d, ensure_ascii=False)) + "\n")
    return str(path)


def articles(spark, tmp_path, docs, order="dedupe_first", **opts):
    raw = read_publications(spark, write_docs(tmp_path, docs))
    return normalize_publications(clean_publications(raw, order=order), **opts)


def load(spark, tmp_path, docs, current=None, idempotent=False, order="dedupe_first", **opts):
    return load_star(articles(spark, tmp_path, docs, order=order, **opts), current, idempotent=idempotent)


def col(df, name):
    return canon((r[name],) for r in df.collect())


def collected(tables):
    return {name: [r.asDict() for r in df.collect()] for name, df in tables.items()}


# One batch, default mode: each document below exercises one case and has a
# journal of its own, so the cases do not interact.
DEFAULT_BATCH = [
    doc("g2", "Empty DOI (j2)", doi=""),
    doc("g3", "Neighbour (j3)", Quartils=[{"année": "2020", "quartil": "Q1"}]),
    doc("g3b", "Other neighbour (j3b)", Quartils="text"),
    doc("g4", "No quartils (j4)"),
    doc("g5", "[2023]"),
    doc("g6", "Deep Nets (part 1)"),
    doc("g7", "Print only (j7)", ISSN={"Print ISSN": "1"}),
    doc("g8a", "P1 (j8)", authors=("A8", "B8", "A8")),
    doc("g8b", "P2 (j8)", authors=("B8",)),
    doc("g9b", "J9 (second)", ISSN="second"),
    doc("g9a", "J9 (first)", ISSN="first"),
    doc("g10a", "J10 (a)", Quartils=[{"année": "2020", "quartil": "Q2"}]),
    doc("g10b", "J10 (b)", Quartils=[{"année": "2020", "quartil": "Q1"}]),
    doc("g11", "Not indexed (j11)", Quartils="Journal pas indexé Scopus"),
    doc("g12", "Bare tail (j12)", Quartils=[{"année": "2020", "quartil": "Q1"}, "bare"]),
    doc("g13", "Object (j13)", Quartils={"année": "2020", "quartil": "Q1"}),
    doc("g14", "Null year (j14)", Quartils=[{"année": None, "quartil": "Q1"}]),
    doc("g15", "Numeric year (j15)", Quartils=[{"année": 2020, "quartil": "Q3"}]),
    doc("g16", "Short month (j16)", date="15 Mar 2023", Quartils=[{"année": "2020", "quartil": "Q1"}]),
    doc("g17", "Prefix only (j17)", date="Date of Publication: "),
    doc("g21a", "Upper abstract (j21)", Abstract="upper"),
    doc("g21b", "Lower abstract (j21)", abstract="lower"),
]


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    t = load(spark, tmp_path_factory.mktemp("golden"), DEFAULT_BATCH)
    out = collected(t)
    journals = {r["journal_id"]: r for r in out["dim_journal"]}
    out["journal_by_name"] = {r["journal_main"]: r for r in out["dim_journal"]}
    out["fact_by_title"] = {r["title"]: r for r in out["fact_publication"]}
    out["quartiles_by_journal"] = {}
    for q in out["journal_quartile"]:
        out["quartiles_by_journal"].setdefault(journals[q["id_journal"]]["journal_main"], []).append(
            (q["annee"], q["quartil"]))
    out["quarantine_by_order"] = {r["load_order"]: r for r in out["quarantine"]}
    return out


def test_g1_dedupe_before_null_filter(spark, tmp_path):
    docs = [doc("1", "T", doi=None), doc("2", "T", doi="x")]
    assert articles(spark, tmp_path, docs).count() == 0
    swapped = [doc("1", "T", doi="x"), doc("2", "T", doi=None)]
    assert col(articles(spark, tmp_path, swapped), "doi") == [("x",)]
    assert col(articles(spark, tmp_path, docs, order="filter_first"), "doi") == [("x",)]


def test_g2_empty_doi_kept(batch):
    assert batch["fact_by_title"]["Empty DOI (j2)"]["doi"] == ""


def test_g3_result_independent_of_neighbours(batch, spark, tmp_path):
    alone = load(spark, tmp_path, [doc("g3", "Neighbour (j3)", Quartils=[{"année": "2020", "quartil": "Q1"}])])
    assert [(r["annee"], r["quartil"]) for r in alone["journal_quartile"].collect()] == \
        batch["quartiles_by_journal"]["Neighbour"] == [("2020", "Q1")]


def test_g4_no_quartils(batch):
    assert batch["fact_by_title"]["No quartils (j4)"]["quartils"] == "Non disponible"
    assert batch["journal_by_name"]["No quartils"]["quartils"] == "pas indexe"


def test_g5_bracket_title_stays_text(batch):
    assert "[2023]" in batch["fact_by_title"]


def test_g6_journal_from_title(batch, spark, tmp_path):
    assert batch["fact_by_title"]["Deep Nets (part 1)"]["journal_id"] == batch["journal_by_name"]["Deep Nets"]["journal_id"]
    field = load(spark, tmp_path, [doc("1", "X", journal_main="Published in: Real Journal (Vol 1)")],
                 journal_from="field")
    assert col(field["dim_journal"], "journal_main") == [("Real Journal",)]


def test_g7_issn_object_without_electronic(batch):
    assert batch["journal_by_name"]["Print only"]["issn"] == "Non disponible"


def test_g8_authors_and_bridge(batch):
    names = {r["author_id"]: r["author_name"] for r in batch["dim_author"]}
    ids = {batch["fact_by_title"][t]["publication_id"] for t in ("P1 (j8)", "P2 (j8)")}
    pairs = [(b["publication_id"], names[b["author_id"]]) for b in batch["publication_author"] if b["publication_id"] in ids]
    assert sorted(n for _, n in pairs) == ["A8", "B8", "B8"]
    assert {"A8", "B8"} <= set(names.values())


def test_g9_first_issn_wins(batch):
    assert batch["journal_by_name"]["J9"]["issn"] == "first"
    assert batch["fact_by_title"]["J9 (second)"]["journal_id"] == batch["journal_by_name"]["J9"]["journal_id"]


def test_g10_last_quartile_wins(batch):
    assert batch["quartiles_by_journal"]["J10"] == [("2020", "Q1")]


def test_g11_not_indexed_text(batch):
    assert batch["journal_by_name"]["Not indexed"]["quartils"] == "pas indexe"
    assert batch["fact_by_title"]["Not indexed (j11)"]["quartils"] == "Non disponible"


def test_g12_last_item_bare_string(batch):
    assert batch["quartiles_by_journal"]["Bare tail"] == [("2020", "Q1")]
    assert batch["fact_by_title"]["Bare tail (j12)"]["quartils"] == "Non disponible"


def test_g13_quartils_object(batch):
    assert batch["journal_by_name"]["Object"]["quartils"] == "pas indexe"
    assert batch["fact_by_title"]["Object (j13)"]["quartils"] == "Non disponible"


def test_g14_null_year_item(batch):
    assert batch["journal_by_name"]["Null year"]["quartils"] == "indexe"
    assert "Null year" not in batch["quartiles_by_journal"]


def test_g15_numeric_year(batch):
    assert batch["quartiles_by_journal"]["Numeric year"] == [("2020", "Q3")]


def test_g16_bad_date_quarantined_before_journal(batch):
    assert "Short month" not in batch["journal_by_name"]
    q = batch["quarantine_by_order"]["g16"]
    assert (q["reject_reason"], q["reject_stage"]) == ("unparseable_publication_date", "before_journal")


def test_g17_prefix_only_date(batch):
    assert batch["fact_by_title"]["Prefix only (j17)"]["publication_date"] is None


def test_g21_case_sensitive_abstract(batch):
    assert batch["fact_by_title"]["Upper abstract (j21)"]["abstract"] is None
    assert batch["fact_by_title"]["Lower abstract (j21)"]["abstract"] == "lower"


def test_strict_parity(spark, tmp_path):
    t = collected(load(spark, tmp_path, [
        doc("s11", "Not indexed (j11)", Quartils="Journal pas indexé Scopus"),
        doc("s12", "Bare tail (j12)", Quartils=[{"année": "2020", "quartil": "Q1"}, "bare"]),
        doc("s13", "Object (j13)", Quartils={"année": "2020", "quartil": "Q1"}),
        doc("s4", "No quartils (j4)")], strict_parity=True))
    reasons = {r["load_order"]: r["reject_reason"] for r in t["quarantine"]}
    assert reasons == {"s11": "quartils_not_a_list", "s12": "last_quartil_not_an_object"}
    assert sorted(r["journal_main"] for r in t["dim_journal"]) == ["Bare tail", "No quartils", "Not indexed", "Object"]
    assert len(t["journal_quartile"]) == 1
    assert sorted(r["title"] for r in t["fact_publication"]) == ["No quartils (j4)", "Object (j13)"]


def test_g18_normalized_scores(spark, tmp_path):
    items = [{"année": str(2000 + i), "quartil": v} for i, v in enumerate(["4.0", "3.99", "2", "1", "0", "nan", "Q2", "4d"])]
    t = load(spark, tmp_path, [doc("1", "T", Quartils=items)], normalize_quartiles=True)
    got = dict((r["annee"], r["quartil"]) for r in t["journal_quartile"].collect())
    assert [got[str(2000 + i)] for i in range(8)] == ["Q1", "Q2", "Q2", "Q3", "Q4", "Q4", "Q2", "4d"]


def test_g19_length_limits(spark, tmp_path):
    t = collected(load(spark, tmp_path, [doc("a", "x" * 300 + " (j)"), doc("b", "J (" + "x" * 300 + ")")],
                       length_check=True))
    reasons = {r["load_order"]: (r["reject_reason"], r["reject_stage"]) for r in t["quarantine"]}
    assert reasons == {"a": ("journal_main_too_long", "before_journal"), "b": ("title_too_long", "after_journal")}
    assert [r["journal_main"] for r in t["dim_journal"]] == ["J"]  # created before the title failed


def test_g20_rerun(spark, tmp_path):
    docs = [doc("1", "A (j)"), doc("2", "B (k)", Quartils=[{"année": "2020", "quartil": "Q1"}])]
    first = load(spark, tmp_path, docs)
    current = {k: v for k, v in first.items() if k != "quarantine"}
    again = load(spark, tmp_path, docs, current=current)
    assert [r[0] for r in col(again["fact_publication"], "publication_id")] == [1, 2, 3, 4]
    for dim in ("dim_journal", "dim_author", "journal_quartile", "dim_date"):
        assert sorted(again[dim].collect()) == sorted(first[dim].collect())
    idem = load(spark, tmp_path, docs, current=current, idempotent=True)
    assert idem["fact_publication"].count() == 2


def test_required_keys_and_malformed(spark, tmp_path):
    docs = [doc("1", "A"), {"_id": "2", "Title": "B", "DOI": "x", "Publication Date": "1 May 2020"},
            {"_id": "3", "Title": "C", "DOI": None, "Authors": [], "Publication Date": "1 May 2020"},
            "not json at all", "[1, 2]"]
    raw = read_publications(spark, write_docs(tmp_path, docs))
    got = [(r["_id"], r["__required_reason"]) for r in raw.collect()]
    reasons = dict(got)
    assert reasons["1"] is None and reasons["2"] == "missing_required_keys"
    assert [r for _, r in got].count("not_an_object") == 2
    # A key present with a null value counts as present; the null DOI then fails the clean step.
    assert reasons["3"] is None


def test_good_plus_quarantine_is_input(spark, tmp_path):
    docs = [doc(str(i), f"T{i} (j{i % 3})", date=["1 May 2020", "bad date", ""][i % 3]) for i in range(30)]
    arts = articles(spark, tmp_path, docs)
    t = load_star(arts)
    assert t["fact_publication"].count() + t["quarantine"].count() == arts.count() == 30


def test_one_batch_equals_two_batches(spark, tmp_path):
    docs = [doc(f"{i:03d}", f"T{i} (J{i % 4})", ISSN=f"I{i}", authors=(f"a{i % 5}", f"a{i % 7}"),
                Quartils=[{"année": str(2000 + i % 3), "quartil": f"Q{1 + i % 4}"}]) for i in range(40)]
    whole = load(spark, tmp_path, docs)
    first = load(spark, tmp_path, docs[:17])
    second = load(spark, tmp_path, docs[17:], current={k: v for k, v in first.items() if k != "quarantine"})

    def natural(t):
        j = t["dim_journal"]
        q = t["journal_quartile"].join(j, F.col("id_journal") == F.col("journal_id"))
        return (sorted((r["journal_main"], r["issn"], r["quartils"]) for r in j.collect()),
                sorted((r["journal_main"], r["annee"], r["quartil"]) for r in q.collect()),
                sorted(r["title"] for r in t["fact_publication"].collect()),
                sorted(r["author_name"] for r in t["dim_author"].collect()))
    assert natural(whole) == natural(second)


def test_result_independent_of_partitioning(spark, tmp_path):
    docs = [doc(f"{i:03d}", f"T{i % 9} (J{i % 4})", ISSN=f"I{i}") for i in range(60)]
    raw = read_publications(spark, write_docs(tmp_path, docs))
    a = load_star(normalize_publications(clean_publications(raw)))
    b = load_star(normalize_publications(clean_publications(raw.repartition(13))))
    for name in ("dim_journal", "fact_publication", "dim_author"):
        assert sorted(a[name].collect()) == sorted(b[name].collect())


def test_salted_load_equals_plain_load(spark, tmp_path):
    docs = [doc(f"{i:03d}", f"{'Hot' if i % 3 == 0 else 'J' + str(i % 5)} (p{i})", ISSN=f"I{i}",
                authors=("Popular", f"a{i % 4}"), Quartils=[{"année": str(2000 + i % 3), "quartil": f"Q{1 + i % 4}"}])
            for i in range(45)]
    arts = articles(spark, tmp_path, docs)
    plain, salted = load_star(arts), load_star(arts, salt_buckets=4)
    for name in ("dim_journal", "journal_quartile", "fact_publication", "publication_author", "dim_author"):
        assert sorted(plain[name].collect()) == sorted(salted[name].collect()), name


def test_case_insensitive_journal_match(spark, tmp_path):
    docs = [doc("1", "Nature (a)", ISSN="first", Quartils=[{"année": "2020", "quartil": "Q2"}]),
            doc("2", "NATURE (b)", ISSN="second", Quartils=[{"année": "2020", "quartil": "Q1"}])]
    exact = load(spark, tmp_path, docs)
    assert exact["dim_journal"].count() == 2
    arts = articles(spark, tmp_path, docs)
    lower = load_star(arts, journal_match="lower")
    assert [(r["journal_main"], r["issn"]) for r in lower["dim_journal"].collect()] == [("Nature", "first")]
    assert [(r["annee"], r["quartil"]) for r in lower["journal_quartile"].collect()] == [("2020", "Q1")]
    assert sorted(r["journal_id"] for r in lower["fact_publication"].collect()) == [1, 1]


def test_no_orphans_in_loaded_tables(batch):
    """Every foreign key of the load points at an existing row (P13)."""
    authors = {r["author_id"] for r in batch["dim_author"]}
    pubs = {r["publication_id"] for r in batch["fact_publication"]}
    journals = {r["journal_id"] for r in batch["dim_journal"]}
    assert all(b["author_id"] in authors and b["publication_id"] in pubs for b in batch["publication_author"])
    assert all(f["journal_id"] in journals for f in batch["fact_publication"])
    assert all(q["id_journal"] in journals for q in batch["journal_quartile"])
    keys = [r["journal_id"] for r in batch["dim_journal"]]
    assert sorted(keys) == list(range(1, len(keys) + 1))  # dense, no gaps


def test_missing_journal_line_is_quarantined_before_journal(spark, tmp_path):
    arts = articles(spark, tmp_path, [doc("1", "No field"), doc("2", "Has field", journal_main="Published in: J (v)")],
                    journal_from="field")
    got = {r["load_order"]: (r["journal_name"], r["reject_reason"], r["reject_stage"]) for r in arts.collect()}
    assert got == {"1": (None, "journal_name_missing", "before_journal"), "2": ("J", None, None)}

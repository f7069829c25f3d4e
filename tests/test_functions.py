"""Scalar rules: written tables of input and expected value, and properties against Python's own
``strptime``, ``float`` and ``str.strip``."""

from __future__ import annotations

import math
from datetime import date, datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom import functions as CF

MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September",
          "October", "November", "December"]


def _one_col(spark, values, name="s"):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(name, T.StringType())]))


def _table(spark, cases, *cols):
    """The rows of a table of cases by input text."""
    return {r["s"]: r for r in _one_col(spark, list(cases)).select("s", *cols).collect()}


# text -> (date, rejected)
DATES = {
    "15 March 2023": (date(2023, 3, 15), False), "Date of Publication: 15 March 2023": (date(2023, 3, 15), False),
    "Date of Publication: ": (None, False), "": (None, False), None: (None, False), "15 Mar 2023": (None, True),
    "31 February 2023": (None, True), "29 February 2024": (date(2024, 2, 29), False), "29 February 2023": (None, True),
    "5 march 2023": (date(2023, 3, 5), False), "05 MARCH 2023": (date(2023, 3, 5), False),
    "15  March 2023": (date(2023, 3, 15), False), "15\tMarch 2023": (date(2023, 3, 15), False), " 15 March 2023": (None, True),
    " 5 March 2023": (date(2023, 3, 5), False), "15 March 2023 ": (None, True), "15 March 23": (None, True),
    "15 March 20231": (None, True), "0 March 2023": (None, True), "32 March 2023": (None, True), "1 January 0000": (None, True),
    "1 January 0001": (date(1, 1, 1), False), "15 Sept 2023": (None, True), "7 July 2020x": (None, True),
    "5 March 2023\n": (None, True), "5 March 2023\u2028": (None, True), "5 March 2023\r\n": (None, True),
}


def test_publication_dates(spark):
    got = _table(spark, DATES, CF.parse_publication_date("s").alias("d"), CF.publication_date_rejected("s").alias("bad"))
    for text, want in DATES.items():
        assert (got[text]["d"], got[text]["bad"]) == want, repr(text)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.sampled_from([*MONTHS, "Mar", "sept", "MAY"]), st.integers(1, 12000),
                          st.sampled_from([" ", "  ", "\t", "\u2003"]), st.sampled_from(["", "\n", " ", "."])),
                min_size=1, max_size=20))
def test_dates_agree_with_strptime(spark, parts):
    texts = [f"{day}{gap}{month} {year:04d}{tail}" for day, month, year, gap, tail in parts]
    for text, r in _table(spark, texts, CF.parse_publication_date("s").alias("d")).items():
        try:
            want = datetime.strptime(text, "%d %B %Y").date()
        except ValueError:
            want = None
        assert r["d"] == want, repr(text)


JOURNALS = {
    "Published in: Deep Nets (part 1)": "Deep Nets", "Published in:Deep Nets": "Deep Nets", "Published in:   Spaces   ": "Spaces",
    "Published in: (x) y": "", "Published in: ": "", "Published in: \nNext line": "Next line",
    "Published in: A\nB (c)": "A", "Published in: \u00a0Nbsp Journal (1)": "Nbsp Journal", "Published in: Em space\u2003": "Em space",
    "no prefix here": None, "xx Published in: Later (z)": "Later", "Published in: Tab\tinside (q)": "Tab\tinside",
    "Published in: \x1ctrail\x1c": "trail",
}


def test_journal_names(spark):
    got = _table(spark, JOURNALS, CF.extract_journal_name("s").alias("j"))
    for line, want in JOURNALS.items():
        assert got[line]["j"] == want, repr(line)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet=st.sampled_from(list("ab \t\u00a0\u2003\x85")), max_size=8),
                          st.sampled_from(["", "(rest)", "\nnext", "( a ( b"])), min_size=1, max_size=20))
def test_journal_names_are_stripped_as_python_strips(spark, parts):
    names = {"Published in: x" + name + tail: ("x" + name).strip() for name, tail in parts}
    for line, r in _table(spark, names, CF.extract_journal_name("s").alias("j")).items():
        assert r["j"] == names[line], repr(line)


SCORES = {
    "4": "Q1", "4.0": "Q1", "3.99": "Q2", "2": "Q2", "1": "Q3", "0": "Q4", "-1": "Q4", "nan": "Q4", "NaN": "Q4", " 2.5 ": "Q2",
    "inf": "Q1", "-inf": "Q4", "Q2": "Q2", "4d": "4d", "1e1": "Q1", "1_000": "Q1", "1__0": "1__0", "_1": "_1", ".5": "Q4",
    "5.": "Q1", "+3": "Q2", "": "", "  ": "  ", "0x10": "0x10", "1e": "1e", "Infinity": "Q1", None: None,
}


def test_scores_become_quartiles(spark):
    got = _table(spark, SCORES, CF.normalize_quartile("s").alias("q"))
    for text, want in SCORES.items():
        assert got[text]["q"] == want, repr(text)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("0123456789.+-e_ infaQ")), max_size=6), min_size=1, max_size=20))
def test_texts_that_float_rejects_stay(spark, texts):
    for text, r in _table(spark, texts, CF.normalize_quartile("s").alias("q")).items():
        try:
            float(text)
        except ValueError:
            assert r["q"] == text, repr(text)
        else:
            assert r["q"] in ("Q1", "Q2", "Q3", "Q4"), repr(text)


def test_quartile_from_score_nan_and_null(spark):
    vals = [4.0, 3.99, 2.0, 1.0, 0.0, float("nan"), None, float("inf")]
    df = spark.createDataFrame([(v,) for v in vals], "x double").select(
        "x", CF.quartile_from_score("x").alias("q"))
    got = [(r["x"], r["q"]) for r in df.collect()]
    expect = {4.0: "Q1", 3.99: "Q2", 2.0: "Q2", 1.0: "Q3", 0.0: "Q4", None: None, float("inf"): "Q1"}
    for x, q in got:
        if x is not None and math.isnan(x):
            assert q == "Q4"
        else:
            assert q == expect[x]


TIMES = {
    "2024-01-02 03:04:05": "2024-01-02T03:04:05Z", "2024-1-2 3:4:5": "2024-01-02T03:04:05Z",
    "2024-01-02  03:04:05": "2024-01-02T03:04:05Z", "2024-01-02 03:04:60": None, "2024-02-30 00:00:00": None, "bad": None,
    "": None, None: None, "2024-01-02T03:04:05": None, "0000-01-01 00:00:00": None, "2024-01-02 03:04:05 ": None,
    "2024-01-02 03:04:05\n": None, "2024-01- 2 03:04:05": "2024-01-02T03:04:05Z", "2024-12-31 23:59:59": "2024-12-31T23:59:59Z",
}


def test_sensor_times(spark):
    got = _table(spark, TIMES, CF.iso_utc_text(CF.parse_sensor_timestamp("s")).alias("iso"))
    for text, want in TIMES.items():
        assert got[text]["iso"] == want, repr(text)


ISSNS = {
    '{"Electronic ISSN": "1234"}': "1234", '{"Print ISSN": "1"}': "Non disponible", "5678": "5678", None: "Non disponible",
    '["a"]': "Non disponible", "": "", '{"Electronic ISSN": 77}': "77", "['a']": "['a']",
}


def test_issns(spark):
    got = _table(spark, ISSNS, CF.issn_value("s").alias("i"))
    for text, want in ISSNS.items():
        assert got[text]["i"] == want, repr(text)


# text -> (kind, flag, items, last quartile, last item is no object)
QUARTILS = {
    '[{"année": "2020", "quartil": "Q2"}, {"année": "2021", "quartil": "Q1"}]':
        ("list", "indexe", [("2020", "Q2"), ("2021", "Q1")], "Q1", False),
    '[{"année": "2020"}, "x", {"année": "2021", "quartil": "Q3"}]': ("list", "indexe", [("2021", "Q3")], "Q3", False),
    "[]": ("list", "pas indexe", [], "Non disponible", False),
    "Journal pas indexé Scopus": ("string", "pas indexe", [], "Non disponible", False),
    "other": ("string", "pas indexe", [], "Non disponible", False),
    '{"année": "2020", "quartil": "Q1"}': ("object", "pas indexe", [], "Non disponible", False),
    '[{"année": null, "quartil": "Q1"}]': ("list", "indexe", [], "Q1", False),
    '[{"année": 2020, "quartil": "Q4"}, "tail"]': ("list", "indexe", [("2020", "Q4")], "Non disponible", True),
    "[not json]": ("string", "pas indexe", [], "Non disponible", False),
    "['Ann', 'Bo']": ("string", "pas indexe", [], "Non disponible", False),
    "[{'année': '2020', 'quartil': 'Q1'}]": ("string", "pas indexe", [], "Non disponible", False),
    "[1] and [2]": ("string", "pas indexe", [], "Non disponible", False),
    '["a"] x]': ("string", "pas indexe", [], "Non disponible", False),
    '["a"]] []': ("string", "pas indexe", [], "Non disponible", False),
    '["a"], ["b"]': ("string", "pas indexe", [], "Non disponible", False),
    '[{"année": "", "quartil": "Q1"}]': ("list", "indexe", [], "Q1", False),
    '[{"année": "2018", "quartil": null}]': ("list", "indexe", [], None, False),
    '[{"année": "2018"}]': ("list", "pas indexe", [], "Non disponible", False),
    "": ("string", "pas indexe", [], "Non disponible", False),
    '[{"année": "2018", "quartil": 0}, {"année": "2018", "quartil": 0.0}, {"année": 0, "quartil": "Q1"}, '
    '{"année": "2018", "quartil": false}, {"année": "2018", "quartil": []}, {"année": "2018", "quartil": {}}, '
    '{"année": "2018", "quartil": "0"}, {"année": "2018", "quartil": 0.5}, {"année": "2018", "quartil": true}]':
        ("list", "indexe", [("2018", "0"), ("2018", "0.5"), ("2018", "true")], "true", False),
    # Lists in the original's sense that VARIANT refuses: a repeated key, no number.
    '[{"année": "2018", "quartil": "Q4", "quartil": "Q1"}, {"année": "2019", "quartil": "Q2"}]':
        ("list", "indexe", [("2018", "Q1"), ("2019", "Q2")], "Q2", False),
    '[NaN, {"année": "2019", "quartil": "Q2"}]': ("list", "indexe", [("2019", "Q2")], "Q2", False),
    '[{"année": "2019", "quartil": "Q2"}, null]': ("list", "indexe", [("2019", "Q2")], "Non disponible", True),
    '[["année", "quartil"]]': ("list", "pas indexe", [], "Non disponible", True),
    '["a"]], "b"], ["c"]': ("string", "pas indexe", [], "Non disponible", False),
    '[{"année": "\ue000end of text\ue000", "quartil": "Q2"}]':
        ("list", "indexe", [("\ue000end of text\ue000", "Q2")], "Q2", False),
}


def test_quartils(spark):
    el = CF.decode_list("s")
    kind = CF.quartils_kind("s", el)
    got = _table(spark, QUARTILS, kind.alias("kind"), CF.journal_flag(el).alias("flag"), CF.quartile_items(el).alias("items"),
                 CF.last_quartil(el).alias("last"), CF.last_item_not_object(el).alias("last_bad"))
    for text, want in QUARTILS.items():
        r = got[text]
        assert (r["kind"], r["flag"], [(i["annee"], i["quartil"]) for i in r["items"]], r["last"], r["last_bad"]) == want, text


def test_authors_array(spark):
    texts = ['["A", "B", "A"]', "Solo", None, "[]", '["X", null]']
    got = [r["a"] for r in _one_col(spark, texts).select(CF.authors_array("s").alias("a")).collect()]
    assert got == [["A", "B", "A"], ["Solo"], [], [], ["X", None]]


def test_json_roundtrip(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, "not json")], "id long, props string")
    out = df.select("id", CF.from_json_text("props", "k long")["k"].alias("k"))
    assert sorted((r["id"], r["k"]) for r in out.collect()) == [(1, 5), (2, None)]
    enc = out.select(CF.to_json_text(F.col("id"), F.col("k"), name="j")).collect()
    assert sorted(r["j"] for r in enc) == ['{"id":1,"k":5}', '{"id":2,"k":null}']

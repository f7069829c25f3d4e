from __future__ import annotations

from collections import Counter

import pytest

from citeloom.llm import quality

from .edge import BLANK_WORD, documents, empty, ordered


def measures(text):
    words = BLANK_WORD.findall(text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if BLANK_WORD.search(x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(hit), len(words) < 50 or 100 * len(hit) > 50 * len(words))


def test_measures_match_brute_force(spark):
    docs = documents(spark)
    want = ordered((r.doc_id, *measures(r.text)) for r in docs.collect())
    got = ordered(quality.quality_digest(docs).drop("kept", "n_bad_lines", "lost_chars").collect())
    assert got == want


def test_many_repeats_in_long_texts(spark):
    docs = documents(spark, rows=["a b c " * 3000, "a a a a a", "a b c a b c", "a b c d a b c", " ".join(map(str, range(9000)))])
    want = ordered((r.doc_id, *measures(r.text)) for r in docs.collect())
    assert ordered(quality.quality_digest(docs).drop("kept", "n_bad_lines", "lost_chars").collect()) == want


CLEAN = "Plain words stand in this line, and they end as they should.\n"


@pytest.mark.parametrize("line, bad", [
    ("Plain words stand here, as they should.", False),
    ("Odd&&& marks### follow$$$ every*** word%%%", True),
    ("SHOUT!! EVERY!! WORD!! HERE!!", True),
    ("home | news | about | contact", True),
    ("a | b in a longer line of words that has only one separator", False),
    ("We use cookies to improve this site.", True),
    ("Privacy Policy", True),
    ("word " * 45, True),
    ("word " * 20, False),
    ("Licensed under the Apache License, Version 2.0.", False),
    ("", False),
])
def test_line_rules(spark, line, bad):
    text = CLEAN * 8 + line + "\n" + CLEAN
    row = (quality.annotate(spark.createDataFrame([(1, text)], "doc_id long, text string"))
           .select("quality.*").first())
    assert row.n_bad_lines == int(bad)
    assert row.cleaned == (CLEAN * 9 if bad else text)


def test_documents_that_lose_too_much_go(spark):
    good = "".join(" ".join(f"w{i}x{k}" for k in range(9)) + ", at last.\n" for i in range(12))
    menu = "".join(f"home{i} | news{i} | about{i} | more{i} | last{i}\n" for i in range(12))
    docs = spark.createDataFrame([(1, good, 5), (2, good + menu[:120], 5), (3, menu + good[:200], 5), (4, None, 5)],
                                 "doc_id long, text string, n_chars int")
    kept = {r.doc_id: r for r in quality.keep_clean(docs).collect()}
    assert set(kept) == {1, 2}
    assert kept[1].text == good and kept[1].n_chars == len(good)
    assert "|" not in kept[2].text or kept[2].text.count("|") < 3
    assert quality.keep_clean(docs).columns == docs.columns


def test_columns_pass_and_empty_tables(spark):
    docs = documents(spark)
    kept = quality.keep_clean(docs)
    assert kept.dtypes == docs.dtypes
    assert quality.keep_clean(empty(spark)).count() == 0
    assert quality.quality_digest(empty(spark)).count() == 0
    annotated = quality.annotate(docs)
    assert annotated.count() == docs.count() and annotated.select("quality.kept").dtypes == [("kept", "boolean")]


def test_no_python_in_the_plan(spark):
    plan = quality.quality_digest(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.split("Physical Plan")[1].replace(
        "Exchange RoundRobin", "")

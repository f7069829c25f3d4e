from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest

from citeloom.llm import decontam

from .edge import ALNUM_WORD, documents, empty, lower, ordered, texts

SCHEMA = "item_id long, text string, doc_id long, words string, len int"


def items(spark, listed):
    return spark.createDataFrame([(i, t, 0, "clash", 1) for i, t in listed], SCHEMA)


def brute(docs, bench):
    windows = defaultdict(set)
    for item in bench:
        w = ALNUM_WORD.findall(lower(item.text))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i:i + n])].add(item.item_id)
    lengths = {len(k) for k in windows}
    out = []
    for d in docs:
        w, hit, found = ALNUM_WORD.findall(lower(d.text)), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i:i + n]))
                if got:
                    found |= got
                    hit |= set(range(i, i + n))
        listed = ",".join(sorted(map(str, found - {None})))
        out.append((d.doc_id, len(w), len(hit), len(found - {None}), hashlib.sha256(listed.encode()).hexdigest(),
                    bool(hit)))
    return ordered(out)


def check(spark, docs, bench):
    assert ordered(decontam.decontam_digest(docs, bench).collect()) == brute(docs.collect(), bench.collect())


def test_spans_of_long_items(spark):
    t = texts()
    cut = t[10].split()[40:70]
    listed = [(1, " ".join(cut)), (2, " ".join(cut[5:])), (12, t[12]), (3, t[20][:4000].upper()), (4, "nothing of it " * 5),
              (5, " ".join(cut[:9]) + " differs"), (1, "a second text of the same item id, with words of its own"), (None, t[9])]
    check(spark, documents(spark, extra=[(700, "before " + " ".join(cut[3:13]) + " after"),
                                         (701, "before " + " ".join(cut[3:12]) + " after")]), items(spark, listed))


def test_items_of_few_words(spark):
    check(spark, documents(spark), items(spark, [(1, "one"), (2, "two words"), (3, "b C d"), (4, ""), (5, None),
                                                 (6, "the"), (7, "non ascii"), (8, "a b c d"), (9, "same line same line same")]))


@pytest.mark.parametrize("n", range(7, 12))
def test_items_as_long_as_a_gram(spark, n):
    """Beside an item of as many words as a gram has, spans that are a word short of a window stay unhit."""
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(i, " ".join(["x", *words[i:i + n], "y"])) for i in range(20)], "doc_id long, text string")
    check(spark, docs, items(spark, [(1, " ".join(words)), (2, " ".join(words[3:3 + decontam.K])), (3, " ".join(words[5:14]))]))


def test_empty_tables(spark):
    check(spark, documents(spark), items(spark, []))
    assert decontam.decontam_digest(empty(spark), items(spark, [(1, "a b")])).count() == 0


def test_large_benchmarks(spark):
    """More fingerprints than the smallest bitmap has room for, many of them met by chance; one passage in most documents."""
    rng = random.Random(2)
    word = lambda: f"v{rng.randint(0, 12)}"
    bench = [(i, " ".join(word() for _ in range(rng.choice([12, 60, 200])))) for i in range(600)]
    shared = bench[5][1].split()[:12]
    docs = [(i, " ".join([word() for _ in range(rng.randint(0, 60))] + (shared if i % 3 else []) + [word() for _ in range(5)]))
            for i in range(300)]
    check(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(4), items(spark, bench))


def test_no_key_is_shared_by_all_documents(spark):
    rows = [(i, f"text number {i} of its own " * 3) for i in range(50)]
    out = decontam.contamination(spark.createDataFrame(rows, "doc_id long, text string"), items(spark, [(1, "a b c " * 9)]))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    keys = set(re.findall(r"hashpartitioning\(([a-z_]+)#", plan))
    assert keys <= {"row", "len"} and "salt" in plan  # by row, or by (len, fp, gram, salt)


@pytest.mark.parametrize("k, window", [(3, 10), (5, 10), (10, 10)])
def test_every_shared_span_is_found(spark, k, window):
    """The guarantee of winnowing does not depend on the gram length."""
    words = [f"w{i * i % 97}" for i in range(200)]
    docs = spark.createDataFrame([(i, " ".join(["x"] * (i % 5) + words[i:i + 10])) for i in range(150)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    assert decontam.contamination(docs, bench, k=k, window=window).where("n_hit < 10").count() == 0


def test_contaminated_documents_go(spark):
    t = texts()
    docs = documents(spark)
    bench = items(spark, [(1, t[10])])
    left = decontam.drop_contaminated(docs, bench)
    bad = {r.doc_id for r in decontam.decontam_digest(docs, bench).where("contaminated").collect()}
    assert bad and left.dtypes == docs.dtypes
    want = [r for r in docs.collect() if r.doc_id not in bad]
    assert ordered(left.collect()) == ordered(want)


def test_no_python_in_the_plan(spark):
    plan = decontam.decontam_digest(documents(spark), items(spark, [(1, "a b c")]))._jdf.queryExecution().toString()
    assert "ArrowEval" not in plan and "BatchEvalPython" not in plan and "MapIn" not in plan

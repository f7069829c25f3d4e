from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pytest

from citeloom.llm import pii

from .edge import documents, empty, ordered

LINES = [
    (900, "mail a.b+c@d.ef, x@y, @z.q and p@q.r.s@t.u"), (901, "1.2.3.4 256.1.1.1 1.2.3.4.5 001.02.003.255 1.2.3"),
    (902, "card 4111 1111-1111 1111 or 4111111111111112, 378282246310005"), (903, "+1 (555) 123-4567, +12, +1.2.3.4.5.6.7.8.9"),
    (904, "é+49 30 1234567é ü@ü.de é@a.b"), (905, "0" * 5000 + "." + "1" * 5000 + ".2.3 " + "9" * 5000), (906, "@" * 300 + "a@b.c"),
    (907, "+4111 1111 1111 1111")]


def brute(text):
    luhn = lambda g: sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(g[::-1])) % 10 == 0
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        g = re.sub("[ -]", "", m[0])
        if 12 <= len(g) <= 19 and luhn(g):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.findall("[0-9]", m[0])) <= 15]
    return sorted(out)


def test_base_spans_match_brute_force(spark):
    docs = documents(spark, extra=LINES)
    want = []
    for r in docs.collect():
        spans = brute(r.text or "")
        listed = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        n = Counter(k for _, k, _ in spans)
        want.append((r.doc_id, n[0], n[1], n[2], n[3], hashlib.sha256(listed.encode()).hexdigest(), listed))
    got = pii.pii_digest(docs).collect()
    plain = [(*tuple(r)[:6], ",".join(x for x in r.spans.split(",") if not x.startswith("term"))) for r in got]
    assert ordered(plain) == ordered(want)


def leaking(spark):
    rows = [(i, f"Some words w{i} here. Passholder reach user{i}@mail.org quickly, w{i}a") for i in range(8)]
    rows += [(100 + i, f"reach the shore quickly, w{i}b; nothing else") for i in range(40)]
    rows += [(200, "passholder without an address"), (201, None), (0, rows[0][1])]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_disclosure_is_information_shared_over_information(spark):
    docs = leaking(spark)
    found = pii.find_entities(docs)
    got = {r.term: r.disclosure for r in pii.disclosing_terms(found, docs, generalise=-9).collect()}
    n = docs.count()
    assert got["passholder"] == pytest.approx(math.log(n * 9 / (10 * 9)) / math.log(n / 9))
    assert got["reach"] == pytest.approx(math.log(n * 9 / (49 * 9)) / math.log(n / 9))
    assert got["reach"] < pii.GENERALISE < got["passholder"]


def test_disclosing_terms_are_marked(spark):
    rows = {(r.doc_id, r.spans) for r in pii.pii_digest(leaking(spark)).collect()}
    marked = {i: s for i, s in rows if "term" in s}
    assert set(marked) == {*range(8), 200}  # 200 holds no entity: the term is what reveals it
    text = "Some words w3 here. Passholder reach user3@mail.org quickly, w3a"
    terms = [text[int(s):int(e)] for k, s, e in (x.split(":") for x in marked[3].split(",")) if k == "term"]
    assert "Passholder" in terms and "reach" not in terms and "quickly" not in terms
    assert marked[200].count("term:") == 1


def test_texts_are_sanitised(spark):
    got = {r.id: r.text for r in pii.sanitised(leaking(spark)).collect()}
    assert "@" not in got[3] and "<EMAIL>" in got[3] and "Passholder" not in got[3] and "reach" in got[3]
    assert got[105] == "reach the shore quickly, w5b; nothing else" and got[201] == ""


def far_off(spark):
    """Emails three in a hundred documents; ``passholder`` far from them, or without one; ``vaultkey`` is rare."""
    rows = [(i, f"Passholder {'and then more ' * 20} user{i}@mail.org {'so on and ' * 20} PASSHOLDER"
             + (" vaultkey" if i < 4 else "")) for i in range(30)]
    rows += [(100 + i, f"and then more so on {'shore' if i % 2 else 'reach'}") for i in range(970)]
    return spark.createDataFrame([*rows, (2000, "a passholder without an address")], "doc_id long, text string")


def test_disclosing_terms_are_marked_at_any_distance(spark):
    docs = far_off(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: [texts[r.doc_id][int(s):int(e)] for k, s, e in (x.split(":") for x in r.spans.split(",") if x)
                      if k == "term"] for r in pii.pii_digest(docs).collect()}
    assert got[3] == ["Passholder", "PASSHOLDER", "vaultkey"] and got[4] == ["Passholder", "PASSHOLDER"]
    assert got[100] == got[101] == []
    assert got[2000] == ["passholder"]  # no entity there: the term is all that reveals one


def test_texts_without_an_entity_are_sanitised(spark):
    got = {r.id: r.text for r in pii.sanitised(far_off(spark)).collect()}
    assert got[2000] == "a  without an address" and got[100] == "and then more so on reach"
    assert "asshol" not in got[3] and "PASS" not in got[3] and "vaultkey" not in got[3] and "and then more" in got[3]


def test_terms_outside_spans_match_word_by_word():
    for _, text in LINES:
        text += " Größe@a.b x1@mail.org-und Wort é49 mail.Wort +49 30 1234567 Ende"
        spans = pii.entities(text)
        words = [m for m in pii.WORD.finditer(text) if not any(s < m.end() and m.start() < e for s, _, e in spans)]
        want = {m[0].encode().lower() for m in words if len(m[0]) >= pii.TERM_LENGTH and not re.search("[0-9]", m[0])}
        assert pii.terms_outside(text, spans) == want


def test_empty_table(spark):
    assert pii.pii_digest(empty(spark)).count() == 0

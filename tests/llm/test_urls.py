from __future__ import annotations

import random
import re

from citeloom.llm import urls

from .edge import ordered

SCHEMA = "page_id long, url string, html string, host string, path string, rule string, verdict string, n long, template string"
URLS = ["https://www.example.com/en/1", "http://a.example.com/en/2?x#y", "HTTP://B.Example.COM/en", "https://example.com", None, "",
        "no scheme", "://", "x://host?query", "https://a.net/es/1", "https://net/fr/", "https://anet/es/", "https://Ünet.net/es/x y",
        "https://example.com/EN/1", "a://b://c.com/d", "https://c.com/\n/x", "https://www.example.com.au/en/", "https://x.com?/en/"]


def pages(spark, listed):
    return spark.createDataFrame([(i, u, None, *["clash"] * 4, 1, "clash") for i, u in listed], SCHEMA)


def parsed(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].encode().lower().decode(), m[2]) if m else ("", "")


def rule(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_hosts_paths_and_rules(spark):
    listed = [*enumerate(URLS), (None, URLS[0]), (3, URLS[3]), (3, URLS[3])]
    got = urls.url_digest(pages(spark, listed)).collect()
    want = [(i, *parsed(u), rule(*parsed(u))[0]) for i, u in listed]
    assert ordered((r.page_id, r.host, r.path, r.rule) for r in got) == ordered(want)
    for r in got:
        by_rule = rule(r.host, r.path)[1]
        assert r.verdict == by_rule if by_rule else r.verdict in ("allow", "block")


def test_variable_segments(spark):
    cases = {"/en/123": ["en", "{n}"], "/a/12.html": ["a", "{n}.html"], "/2024-05-06/x": ["{date}", "x"], "/p/deadbeef01": ["p", "{hex}"],
             "/item-77/": ["item-{n}"], "": [], "/": [], "//a//b": ["a", "b"], "/a/b/c/d/e/f": ["a", "b", "c", "d", "e", "f"],
             "/u/abcDEF0123456789xyz": ["u", "{id}"], "/en/index.html": ["en", "index.html"]}
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "path string, want array<string>")
    assert [r.path for r in rows.where(urls.segments_of(rows.path) != rows.want).collect()] == []


def shapes(spark, listed):
    return spark.createDataFrame([("h", p.strip("/").split("/") if p != "/" else [], n, a, b) for p, n, a, b in listed],
                                 "host string, segments array<string>, n long, allowed long, blocked long")


def test_similar_branches_merge_and_others_stay(spark):
    tree = urls.path_templates(shapes(spark, [("a/x", 30, 0, 30), ("b/x", 30, 0, 30), ("c/x", 60, 60, 0), ("d/x", 9, 0, 0)]))
    got = {tuple(r.segments): r.template for r in tree.collect()}
    assert got[("c", "x")].startswith("/c/") and got[("d", "x")].startswith("/d/")
    judged = {r.template: r.judged for r in urls.judged_templates(tree).collect()}
    assert judged[got[("a", "x")]] == "block" and judged[got[("c", "x")]] == "allow" and judged[got[("d", "x")]] == "allow"


def test_children_that_hardly_repeat_become_one(spark):
    tree = urls.path_templates(shapes(spark, [(f"blog/post{chr(97 + i)}", 1, 0, 1) for i in range(25)] + [("about/us", 5, 5, 0)]))
    assert {r.template for r in tree.collect() if r.segments[0] == "blog"} == {"/blog/*"}


def test_paths_are_told_apart_at_any_depth(spark):
    deep = "/".join("abcdefghij" * 3)
    tree = urls.path_templates(shapes(spark, [
        (deep + "/x/end", 20, 0, 20), (deep + "/y/end", 20, 20, 0), (deep, 3, 0, 0), ("a", 1, 0, 0), ("other/path", 2, 0, 0), ("/", 1, 0, 0)]))
    assert {("/" + "/".join(r.segments)).rstrip("/") for r in tree.collect()} == {r.template for r in tree.collect()}
    judged = {r.template: r.judged for r in urls.judged_templates(tree).collect()}
    assert judged[f"/{deep}/x/end"] == "block" and judged[f"/{deep}/y/end"] == "allow" and judged[f"/{deep}"] == "allow"


def brute_templates(listed):
    """The tree, a level and a node at a time."""
    rows = [(tuple(p.strip("/").split("/")) if p != "/" else (), n, a, b) for p, n, a, b in listed]
    name, level = {r[0]: "" for r in rows}, 0
    while any(len(r[0]) > level for r in rows):
        named = {}
        for node in {name[r[0]] for r in rows if len(r[0]) > level}:
            here = [r for r in rows if name[r[0]] == node and len(r[0]) > level]
            for child in {r[0][level] for r in here}:
                own = [sum(x) for x in zip(*[r[1:] for r in here if r[0][level] == child], strict=True)]
                n, a, b = (sum(x) for x in zip(*[r[1:] for r in here], strict=True))
                children = len({r[0][level] for r in here})
                labels, rest = own[1] + own[2], a + b - own[1] - own[2]
                apart = abs((own[2] + 1) / (labels + 2) - (b - own[2] + 1) / (rest + 2))
                pooled = (b + 2) / (a + b + 4)
                spread = (pooled * (1 - pooled) * (1 / (labels + 2) + 1 / (rest + 2))) ** 0.5
                alike = labels > 0 and rest > 0 and apart <= urls.Z * spread and apart <= urls.NEAR
                variable = children >= urls.VARIABLE_CHILDREN and n < children * urls.REPEATS
                named[node, child] = f"{node}/{'*' if variable or alike else child}"
        for r in rows:
            if len(r[0]) > level:
                name[r[0]] = named[name[r[0]], r[0][level]]
        level += 1
    return name


def test_trees_match_brute_force(spark):
    rng, seen = random.Random(6), {}
    for _ in range(400):
        path = "/".join(rng.choice("abc") + (str(rng.randint(0, 30)) if rng.random() < 0.3 else "") for _ in range(rng.randint(1, 7)))
        seen[path] = (rng.randint(1, 4), rng.randint(0, 2), rng.randint(0, 2))
    listed = [(p, *v) for p, v in seen.items()]
    got = {tuple(r.segments): r.template for r in urls.path_templates(shapes(spark, listed)).collect()}
    assert got == brute_templates(listed)


def test_templates_without_labels_pass(spark):
    """However many pages of their host are blocked: a share of the host is no label of theirs."""
    for blocked in (6, 20, 300):
        listed = [(i, f"https://bad.net/es/{i}") for i in range(blocked)] + [(1000, "https://bad.net/shop/1"), (2000, "https://good.org/shop/1")]
        got = {r.page_id: r for r in urls.url_digest(pages(spark, listed)).collect()}
        for page in (1000, 2000):
            assert got[page].verdict == "allow" and got[page].rule is None and got[page].purity == 0.5
        assert got[0].verdict == "block" and got[0].template == "/es/{n}"


def test_unruled_pages_fall_with_the_labels_of_their_template(spark):
    listed = [(i, f"https://bad.net/{'es' if i % 2 else 'fr'}/news/{i}") for i in range(40)] + [
        (1000 + i, f"https://bad.net/{w}/news/1") for i, w in enumerate(["es", "fr"])]
    got = {r.page_id: r for r in urls.url_digest(pages(spark, listed)).collect()}
    assert {r.verdict for r in got.values()} == {"block"} and {r.template for r in got.values()} == {"/*/news/{n}"}


def test_empty_table(spark):
    assert urls.url_digest(pages(spark, [])).count() == 0

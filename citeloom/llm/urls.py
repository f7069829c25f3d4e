"""URL filter by a path-template tree (DataFrame functions only).

Rules (host, path prefix) decide first; the longest that fits wins. The pages
that a rule decides are the labels of a tree of path templates, one tree a
host: variable path segments (numbers, dates, hashes, identifiers) become
wildcards at once; level by level, the children of a node become one wildcard
branch where they hardly ever repeat, and labelled branches merge where the
share of blocked pages does not tell them apart from their siblings (a
two-proportion test on smoothed shares). A template's purity is the share of
blocked pages among its own labels, smoothed towards one half by two labels.
Templates whose purity reaches ``REJECT`` are rejected, and so are the pages
without a rule that fall under them; templates without labels pass, whatever
the rest of their host is like.

Pages are pre-aggregated to distinct (host, segments) before anything is
shuffled; the tree works on those rows, with two aggregates and two joins a
step, each step written to the shared folder. A step takes every node to where
its paths part (what they share is passed over, as a node with one child
neither merges nor varies), and paths that are alone in their node are done;
so there are as many steps as partings above one another, at any depth. The
verdicts return to the pages by a salted join, as a host may hold a third of
all pages.

Defined results: null urls, and urls without ``://``, have empty host and
path, fit no rule and are judged by the empty template; null page ids and
repeated rows pass through; an empty table gives an empty result; only the id
and url columns are read, others cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

#: (host, path, verdict); a rule fits its host and all subdomains.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: A node's children are variable if it has this many and fewer than REPEATS pages for each.
VARIABLE_CHILDREN = 20
REPEATS = 3
#: Branches merge where the test statistic is at most Z and the shares differ by at most NEAR
#: (with few labels the test alone tells nothing apart).
Z = 1.64
NEAR = 0.25
#: Smoothed share of blocked labels from which a template is rejected, and how many labels the
#: even share counts for that it is smoothed towards.
REJECT = 0.9
PRIOR_LABELS = 2
SALTS = 16


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, null if none does."""
    longest = sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0])), reverse=True)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in reversed(longest):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def generalised(segment: Column) -> Column:
    """A path segment with its variable forms as wildcards; a file's extension stays."""
    ext = F.regexp_extract(segment, r"(\.[A-Za-z][A-Za-z0-9]{0,4})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z][A-Za-z0-9]{0,4}$", "")
    return (F.when(stem.rlike(r"^[0-9]+$"), F.concat(F.lit("{n}"), ext))
            .when(stem.rlike(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$"), F.concat(F.lit("{date}"), ext))
            .when(stem.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{8,}$"), F.concat(F.lit("{hex}"), ext))
            .when(stem.rlike(r"^(?=.*[0-9])[A-Za-z0-9_-]{16,}$"), F.concat(F.lit("{id}"), ext))
            .when(stem.rlike(r"^[A-Za-z_-]+[0-9]+$"),
                  F.concat(F.regexp_extract(stem, r"^([A-Za-z_-]+)", 1), F.lit("{n}"), ext))
            .otherwise(segment))


def segments_of(path: Column) -> Column:
    """The generalised segments of the whole path."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), generalised)


def _shared(low: Column, high: Column) -> Column:
    """Number of leading segments that two paths share: those of the smallest and the largest path
    of a node are shared by all between."""
    both = F.least(F.size(low), F.size(high))
    apart = F.array_position(F.transform(F.zip_with(low, high, lambda a, b: a.eqNullSafe(b)), lambda same: same), False)
    return F.when(apart > 0, (apart - 1).cast("int")).otherwise(both)


def _below(template: Column, segments: Column, since: Column, until: Column) -> Column:
    """A template with the segments from place ``since`` to before ``until``."""
    return F.concat(template, F.array_join(F.transform(
        F.slice(segments, since + 1, F.greatest(until - since, F.lit(0))), lambda x: F.concat(F.lit("/"), x)), ""))


def path_templates(shapes: DataFrame, variable_children: int = VARIABLE_CHILDREN, repeats: int = REPEATS,
                   z: float = Z) -> DataFrame:
    """``shapes`` (host, segments, n, allowed, blocked; one row a distinct path) with the template each
    one falls under."""
    open_ = stored(shapes.withColumns({"template": F.lit(""), "level": F.lit(0)}), "url-tree")
    shape = ["host", "segments", "n", "allowed", "blocked", "template"]
    finished = None
    while True:
        # Merged branches differ above the node: only what lies below it is compared.
        rest = F.slice("segments", F.col("level") + 1, F.size("segments"))
        nodes = open_.groupBy("host", "template", "level").agg(F.min(rest).alias("lowest"), F.max(rest).alias("highest"))
        parting = nodes.select("host", "template", "level",
                               (F.col("level") + _shared(F.col("lowest"), F.col("highest"))).alias("part"))
        at = open_.join(parting, ["host", "template", "level"]).select(
            "host", "segments", "n", "allowed", "blocked",
            _below(F.col("template"), F.col("segments"), F.col("level"), F.col("part")).alias("template"), "part")
        # Paths that end where their node parts are done, and so are those that were alone in it.
        at = stored(at.withColumn("child", F.get("segments", F.col("part"))), "url-tree")
        ended = at.where(F.col("child").isNull()).select(*shape)
        finished = ended if finished is None else finished.unionByName(ended)
        going = at.where(F.col("child").isNotNull())
        if going.isEmpty():
            return finished
        branches = going.groupBy("host", "template", "part", "child").agg(
            F.sum("n").alias("n"), F.sum("allowed").alias("a"), F.sum("blocked").alias("b"))
        parents = branches.groupBy("host", "template", "part").agg(
            F.count("*").alias("children"), F.sum("n").alias("pages"), F.sum("a").alias("all_a"),
            F.sum("b").alias("all_b"))
        own = F.col("a") + F.col("b")
        others_b = F.col("all_b") - F.col("b")
        others = F.col("all_a") + F.col("all_b") - own
        share, others_share = (F.col("b") + 1) / (own + 2), (others_b + 1) / (others + 2)
        pooled = (F.col("all_b") + 2) / (own + others + 4)
        spread = F.sqrt(pooled * (1 - pooled) * (1 / (own + 2) + 1 / (others + 2)))
        apart = F.abs(share - others_share)
        alike = (own > 0) & (others > 0) & (apart <= z * spread) & (apart <= NEAR)
        variable = (F.col("children") >= variable_children) & (F.col("pages") < F.col("children") * repeats)
        named = branches.join(parents, ["host", "template", "part"]).select(
            "host", "template", "part", "child", F.when(variable | alike, F.lit("*")).otherwise(F.col("child")).alias("name"))
        open_ = stored(going.join(named, ["host", "template", "part", "child"]).select(
            "host", "segments", "n", "allowed", "blocked", F.concat("template", F.lit("/"), "name").alias("template"),
            (F.col("part") + 1).alias("level")), "url-tree")


def judged_templates(tree: DataFrame, reject: float = REJECT) -> DataFrame:
    """(host, template) with its label counts, purity and verdict."""
    found = tree.groupBy("host", "template").agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked"))
    purity = ((F.col("blocked") + PRIOR_LABELS * 0.5) / (F.col("allowed") + F.col("blocked") + PRIOR_LABELS))
    return found.withColumn("purity", purity).withColumn(
        "judged", F.when(F.col("purity") >= reject, "block").otherwise("allow"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, template and its purity."""
    p = pages.select(F.col(id_col), F.col(url_col).alias("__url"))
    p = p.withColumns({"host": host_of(F.col("__url")), "path": path_of(F.col("__url"))})
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    p = p.withColumns({"rule": rule, "by_rule": verdict, "segments": segments_of(F.col("path")),
                       "salt": F.pmod(F.xxhash64(F.col(id_col), "__url"), F.lit(SALTS)).cast("int")})
    shapes = p.groupBy("host", "segments").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("by_rule") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("by_rule") == "block", 1)).alias("blocked"))
    tree = path_templates(shapes)
    verdicts = (tree.join(judged_templates(tree).select("host", "template", "purity", "judged"), ["host", "template"])
                .select("host", "segments", "template", "purity", "judged",
                        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    return p.join(verdicts, ["host", "segments", "salt"]).select(
        id_col, "host", "path", "rule", F.coalesce("by_rule", "judged").alias("verdict"), "template", "purity")


def url_digest(pages: DataFrame) -> DataFrame:
    """The digest of ``op5``: one row per page."""
    return judge_urls(pages.select("page_id", "url"))

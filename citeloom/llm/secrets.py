"""Secret scan: candidate strings judged by a random forest.

Candidates are runs of token characters that are long enough and hold a digit or
follow a key word (a key name and its value part at ``=``), strings with the form
of well-known credentials wherever they stand, whole values that are assigned to
a key word, whatever their characters and length, and the password of
``user:password@host``. Candidates may overlap; of secrets that do, one inside
another is left out. A forest then removes false positives by each candidate's length, its character
classes and transitions between them, its dictionary coverage, the path it
stands in and its neighbouring words.

Dictionary coverage comes from the whole corpus: letter trigrams of all words
of all documents (at most 17,576 counts). The share of a candidate's trigrams
that are at least as common as chance would make them is its coverage.

The forest learns from labelled findings (id, start, end, label) where they are
given. Without them, clear cases label themselves: strings in the form of a
credential, passwords before ``@host``, and values after ``key =`` are secrets; digit-only strings, words, numbers and
addresses without a key word are not. At most ``TRAIN_FINDINGS`` findings, by
hash, are used: a bounded, documented sample.

Three passes over the texts (trigrams, findings to learn from, verdicts), all
by task and document; only the trigram counts and the sample reach the driver.

Defined results: null and empty texts have no candidates; null ids and repeated
rows pass through; without anything to learn from every candidate counts as a
secret; an empty table gives an empty result; only the id, text and, if there
is one, path columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[A-Za-z0-9_+/.@-]{12,}(?:={1,2}(?![A-Za-z0-9_+/=.@-]))?")
HAS_DIGIT = re.compile(r"[0-9]")
KEY = re.compile(r"(?i)(token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key)")
#: Texts without any of these (in lower case) hold no key word.
KEY_PARTS = ("token", "secret", "passw", "pwd", "api", "access", "auth", "credential", "private")
#: A whole name with what assigns a value to it; the name is read once, however long it is.
NAMED = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]++)[\"'`]?[\x20\t]*+(?::=|=>|={1,3}|:)(?!//|:)[\x20\t]*"
                   r"(?:(?i:bearer|basic)[\x20\t]+)?")
#: A name that holds a key word, by itself or with parts behind it.
KEY_NAME = re.compile(
    r"(?i:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential)"
    r"(?i:s|orization|entication)?(?:[_A-Z-][A-Za-z0-9_-]*+|[0-9]{1,3})?$")
#: What stands between a name and its value.
ASSIGNS = re.compile(r"[\"'`]?[\x20\t]*(?::=|=>|={1,3}|:)[\x20\t]*(?:(?i:bearer|basic)[\x20\t]+)?[\"'`]?"
                     r"(?:(?i:bearer|basic)[\x20\t]+)?$")
NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")
QUOTED = {q: re.compile(rf"{q}((?:\\.|[^{q}\\\n])+){q}") for q in "\"'`"}
#: A value without quotes ends at a blank, a quote, or the next ``&name=`` or ``;name=``.
BARE = re.compile(r"(?:(?![&;][\w.%-]+=)[^\s\"'`])+")
#: ``user:password@host``; ``mailto:`` and the like name no user.
USERINFO = re.compile(r"(?:://[^\s:/?#@\"'`<>]*|(?<![A-Za-z0-9._%+/-])(?!(?i:mailto|e-?mail|mail|sips?|xmpp|acct|contact):)"
                      r"[A-Za-z0-9._%+-]+):([^\s:/\"'`<>]+)@(?=[A-Za-z0-9\[])")
AFTER_USER = re.compile(r"(?:://[^\s:/?#@\"'`<>]*|(?<![A-Za-z0-9._%+/-])[A-Za-z0-9._%+-]+):$")
#: Forms of well-known credentials (published prefixes).
FORM = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Z])|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|"
                  r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+|sk_live_[A-Za-z0-9]{20,}|"
                  r"-----BEGIN (?:[A-Z0-9]+ )*?PRIVATE KEY-----[A-Za-z0-9+/=\s]++(?:-----END (?:[A-Z0-9]+ )*?PRIVATE KEY-----)?")
FORM_PARTS = ("-----BEGIN", "AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "eyJ", "sk_live_")
ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
PLACEHOLDER = re.compile(r"(?i)(example|sample|dummy|placeholder|changeme|xxxx|your[_-])")
CHECKSUM_NEAR = re.compile(r"(?i)(sha-?(1|256|512)?|md5|checksum|commit|digest|etag|uuid|version)")
TEST_PATH = re.compile(r"(?i)(test|example|sample|fixture|doc)")
HEX = re.compile(r"^[0-9a-fA-F]+$")
WORD = re.compile(rb"[a-z]{3,}")

#: Characters on either side in which neighbouring words are looked for.
NEAR = 40
TRAIN_FINDINGS = 4000
TREES = 25
TREE_DEPTH = 7
SEED = 11
THRESHOLD = 0.5
CLASSES = bytes(1 if 48 <= c <= 57 else 2 if 65 <= c <= 90 else 3 if 97 <= c <= 122 else 0 for c in range(256))
FEATURES = ("length", "digits", "upper", "lower", "other", "transitions", "entropy", "hex", "coverage", "form",
            "placeholder", "quoted", "assigned", "key_near", "checksum_near", "in_path", "test_path", "address",
            "userinfo")


def values(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the values that are assigned to a key word, with or without quotes."""
    end = stop = 0
    for m in NAMED.finditer(text):
        if not KEY_NAME.search(m[1]):
            continue
        at = m.end()
        quoted = QUOTED.get(text[at:at + 1])
        if quoted:
            if found := quoted.match(text, at):
                yield found.span(1)
            continue
        if at >= end:  # else it stands within the value before, which ends where this one does
            found = BARE.match(text, at)
            stop = end = found.end() if found else at
            while stop > at and text[stop - 1] in ",;.)]}&":
                stop -= 1
        if stop > at:
            yield at, stop


def assigned(text: str, s: int) -> bool:
    """Whether what starts at ``s`` is the value of a name with a key word, of any length."""
    between = ASSIGNS.search(text, max(0, s - 2 * NEAR), s)
    if not between or text.startswith(("//", ":"), s):
        return False
    begin = end = between.start()
    while begin and text[begin - 1] in NAME_CHARS:
        begin -= 1
    return bool(KEY_NAME.search(text[begin:end]))


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of the strings that could be secrets, by start; they may overlap."""
    found, rest = set(), text
    if any(x in text for x in FORM_PARTS):
        found.update(m.span() for m in FORM.finditer(text))
        rest = FORM.sub(lambda m: " " * len(m[0]), text)
    for m in TOKEN.finditer(rest):
        s, e = m.span()
        while e > s and text[e - 1] in ".@-/=+_" and not (text[e - 1] == "=" and e - s >= 20):
            e -= 1
        if e - s >= 12 and (HAS_DIGIT.search(text, s, e) or KEY.search(text, max(0, s - NEAR), s)):
            found.add((s, e))
    if "=" in text or ":" in text:
        low = text.lower()
        if any(x in low for x in KEY_PARTS):
            found.update(values(text))
        if "@" in text and ":" in text:
            found.update(m.span(1) for m in USERINFO.finditer(text))
    return sorted(found)


def outermost(spans: list[tuple]) -> list[tuple]:
    """The spans (start, end, ...) that lie within no other one."""
    out: list[tuple] = []
    for x in sorted(spans, key=lambda x: (x[0], -x[1])):
        if not out or x[1] > out[-1][1]:
            out.append(x)
    return out


def trigram(a: int, b: int, c: int) -> int:
    return (a * 26 + b) * 26 + c


def trigram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each letter trigram occurs in the words of all documents (a-z, 17,576 counts)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(26 ** 3, dtype=np.int64)
        letters = np.full(256, -1, dtype=np.int32)
        letters[97:123] = letters[65:91] = np.arange(26)
        for batch in batches:
            for text in batch.column(0):
                x = letters[np.frombuffer(text.as_py() or b"", dtype=np.uint8)]
                if len(x) > 2:
                    good = (x[:-2] >= 0) & (x[1:-1] >= 0) & (x[2:] >= 0)
                    total += np.bincount(((x[:-2] * 26 + x[1:-1]) * 26 + x[2:])[good], minlength=26 ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    rows = (docs.select(F.col(text_col).cast("string").cast("binary").alias("t"))
            .mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(26 ** 3, dtype=np.int64)
    for r in rows:
        out[r["at"]] = r["n"]
    return out


def features(text: str, s: int, e: int, common: np.ndarray, path: str = "") -> list[float]:
    """The numbers by which the forest judges a candidate."""
    token = text[s:e]
    b = token.encode("utf-8", "replace")
    n = len(b)
    kinds = b.translate(CLASSES)
    shares = [kinds.count(k) / n for k in (1, 2, 3, 0)]
    moves = sum(x != y for x, y in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1)
    p = np.array(list(Counter(b).values())) / n
    low = b.lower()
    grams = [trigram(*(c - 97 for c in w[i:i + 3])) for w in WORD.findall(low) for i in range(len(w) - 2)]
    coverage = sum(common[g] for g in grams) / max(1, n - 2)
    before, after = text[max(0, s - NEAR):s], text[e:e + NEAR]
    left = before[-1:]
    return [n, *shares, moves, float(-(p * np.log2(p)).sum()), float(bool(HEX.match(token))), coverage,
            float(bool(FORM.fullmatch(token))), float(bool(PLACEHOLDER.search(token + after))),
            float(left in "\"'`" and left != ""), float(assigned(text, s)),
            float(bool(KEY.search(before))),
            float(bool(CHECKSUM_NEAR.search(before))), float("/" in token or "://" in before[-12:]),
            float(bool(TEST_PATH.search(path))), float(bool(ADDRESS.fullmatch(token))),
            float(after[:1] == "@" and left == ":" and bool(AFTER_USER.search(text, max(0, s - 2 * NEAR), s)))]


def self_label(x: list[float]) -> int | None:
    """1 for a clear secret, 0 for a clear false positive, None if unclear."""
    v = dict(zip(FEATURES, x, strict=True))
    if v["placeholder"]:
        return 0
    if v["form"] or v["userinfo"]:
        return 1
    if v["address"]:
        return None if v["assigned"] else 0
    if v["assigned"] and v["entropy"] >= 2.5 and v["digits"] < 1 and (v["digits"] > 0 or v["quoted"] and v["coverage"] < 0.5):
        return 1
    if not v["key_near"] and (v["digits"] == 1 or v["coverage"] >= 0.5 or v["in_path"] or v["checksum_near"]):
        return 0
    return None


class Forest:
    """Random forest: bootstrap samples, random feature subsets, Gini splits; plain arrays."""

    def __init__(self, trees: int = TREES, depth: int = TREE_DEPTH, seed: int = SEED):
        self.trees, self.depth, self.seed = trees, depth, seed
        self.nodes: list[list[tuple]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        r = np.random.default_rng(self.seed)
        for _ in range(self.trees):
            pick = r.integers(0, len(x), len(x))
            tree: list[tuple] = []
            self._grow(tree, x[pick], y[pick], self.depth, r)
            self.nodes.append(tree)
        return self

    def _grow(self, tree: list, x: np.ndarray, y: np.ndarray, depth: int, r: np.random.Generator) -> int:
        """A node is (feature, cut, left, right), a leaf (-1, share of ones, 0, 0)."""
        at = len(tree)
        tree.append((-1, (y.sum() + 0.5) / (len(y) + 1), 0, 0))
        if depth and len(y) >= 4 and 0 < y.sum() < len(y):
            best = None
            for f in r.choice(x.shape[1], max(1, int(np.sqrt(x.shape[1])) + 1), replace=False):
                order = x[:, f].argsort(kind="stable")
                v, ones = x[order, f], y[order].cumsum()
                cut = np.flatnonzero(v[1:] > v[:-1])
                if len(cut):
                    nl = cut + 1.0
                    nr = len(y) - nl
                    pl, pr = ones[cut] / nl, (ones[-1] - ones[cut]) / nr
                    gini = nl * pl * (1 - pl) + nr * pr * (1 - pr)
                    i = int(gini.argmin())
                    if best is None or gini[i] < best[0]:
                        best = gini[i], f, (v[cut[i]] + v[cut[i] + 1]) / 2
            if best:
                low = x[:, best[1]] <= best[2]
                left = self._grow(tree, x[low], y[low], depth - 1, r)
                right = self._grow(tree, x[~low], y[~low], depth - 1, r)
                tree[at] = int(best[1]), float(best[2]), left, right
        return at

    def score(self, x: list[float]) -> float:
        total = 0.0
        for tree in self.nodes:
            f, value, left, right = tree[0]
            while f >= 0:
                f, value, left, right = tree[left if x[f] <= value else right]
            total += value
        return total / len(self.nodes)


def _input(docs: DataFrame, id_col: str, text_col: str, path_col: str | None) -> DataFrame:
    path = F.col(path_col).cast("string") if path_col else F.lit("")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"),
                       F.coalesce(path, F.lit("")).alias("path"))


def common_trigrams(counts: np.ndarray) -> np.ndarray:
    """1.0 for the trigrams that are at least as common as if all were equally so."""
    return (counts > counts.sum() / len(counts)).astype(np.float64)


def training_findings(docs: DataFrame, common: np.ndarray, findings: DataFrame | None = None, id_col: str = "doc_id",
                      text_col: str = "text", path_col: str | None = None, limit: int = TRAIN_FINDINGS
                      ) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``limit`` findings of each label, by hash.

    ``findings`` has id, start, end and label (1 secret, 0 not); without it clear candidates
    label themselves.
    """
    d = _input(docs, id_col, text_col, path_col)
    if findings is not None:
        marks = findings.select(F.col(id_col).alias("id"), F.struct("start", "end", "label").alias("m"))
        marks = (marks.groupBy("id", "m").agg(F.count("*").alias("n"))
                 .orderBy(F.xxhash64("id", "m")).limit(2 * limit)
                 .groupBy("id").agg(F.collect_list("m").alias("marks")))
        d = d.join(F.broadcast(marks), "id")  # at most 2 * limit findings
    else:
        d = d.withColumn("marks", F.lit(None).cast("array<struct<start:int,end:int,label:int>>"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = [], []
            for row in batch.to_pylist():
                text = row["t"] or ""
                if row["marks"] is None:
                    for s, e in candidates(text):
                        x = features(text, s, e, common, row["path"])
                        y = self_label(x)
                        if y is not None:
                            xs.append(x)
                            ys.append(y)
                else:
                    for m in row["marks"]:
                        xs.append(features(text, m["start"], m["end"], common, row["path"]))
                        ys.append(m["label"])
            yield pa.RecordBatch.from_pydict({"x": pa.array(xs, pa.list_(pa.float64())), "y": pa.array(ys, pa.int32())})

    found = d.select("id", "t", "path", "marks").mapInArrow(learn, "x array<double>, y int").distinct()
    rows = [r for y in (0, 1) for r in found.where(F.col("y") == y).orderBy(F.xxhash64("x")).limit(limit).collect()]
    if len({r["y"] for r in rows}) < 2:
        return np.empty((0, len(FEATURES))), np.empty(0)
    return np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], dtype=float)


RESULT = "id {id}, n_candidates long, secrets array<struct<start:int,end:int,score:double>>, max_score double"


def scan(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         path_col: str | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row: id, number of candidates, the secrets (code points) and the largest score."""
    common = common_trigrams(trigram_counts(docs, text_col))
    x, y = training_findings(docs, common, findings, id_col, text_col, path_col)
    forest = Forest().fit(x, y) if len(y) else None

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("n_candidates", pa.int64()), ("secrets", pa.list_(pa.struct([
            ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))), ("max_score", pa.float64())])
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 256):
                for row in batch.select(["t", "path"]).slice(at, 256).to_pylist():
                    text = row["t"] or ""
                    judged = [(s, e, forest.score(features(text, s, e, common, row["path"])) if forest else 1.0)
                              for s, e in candidates(text)]
                    out.append({"n_candidates": len(judged), "max_score": max((j[2] for j in judged), default=0.0),
                                "secrets": [{"start": s, "end": e, "score": p} for s, e, p in
                                            outermost([j for j in judged if j[2] >= threshold])]})
            made = pa.RecordBatch.from_pylist(out, schema=schema)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made.columns], ["id", *schema.names])

    kind = docs.schema[id_col].dataType.simpleString()
    return _input(docs, id_col, text_col, path_col).mapInArrow(judge, RESULT.format(id=kind))


def secret_digest(docs: DataFrame) -> DataFrame:
    """The result of ``op7``: one row per document with its secrets as start:end, comma-joined."""
    return scan(docs.select("doc_id", "text", "source"), path_col="source").select(
        F.col("id").alias("doc_id"), "n_candidates", F.size("secrets").cast("long").alias("n_secrets"),
        F.concat_ws(",", F.transform("secrets", lambda x: F.concat_ws(
            ":", x["start"].cast("string"), x["end"].cast("string")))).alias("spans"), "max_score")

"""Personal data: patterns, and terms that corpus co-occurrence shows to reveal them.

Protected entities are the spans that the patterns below find. A term (word)
discloses a kind of entity as far as the corpus links the two: with N documents,
n_k of them holding kind k, n_t holding the term and n_tk holding an entity of
kind k and, anywhere outside entities, the term,

    disclosure = log(N n_tk / (n_t n_k)) / log(N / n_k),

the pointwise mutual information over the information of the entity itself; it
is 1 if the term occurs with such entities only. Terms at ``REMOVE`` or above are
removed and those at ``GENERALISE`` or above replaced by their kind's label, if
chance does not explain the link: the Chernoff bound of the chance that n_tk of
n_t documents hold kind k is at most ``ALPHA`` over the number of links looked
at. Every occurrence outside entities is marked, however far from an entity; by
``disclosures`` and ``sanitised`` also in documents without an entity, where the
term is all that reveals one. The digest of ``op9`` marks documents that hold an
entity only.

Three scans of whole texts: entities; in how many documents each term occurs and
meets each kind; where the disclosing terms stand. The last one knows its terms by
a bitmap of fixed size (2 ** 22 bits); its few false positives fall out in the join
by term. Nothing else leaves the tasks.

Defined results: null texts are empty; null ids pass through; repeated rows give repeated rows and count as
documents each; an empty table gives an empty result; only the id and text
columns are read, others cannot clash.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, stored, whole

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_NAME = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
DIGIT = re.compile(rb"[0-9]")
#: Words of a text in its own case.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

#: Chance, over all links of a term and a kind together, that a link of no meaning counts.
ALPHA = 0.05
GENERALISE = 0.7
REMOVE = 0.9
#: Terms are words without digits of this length at least.
TERM_LENGTH = 3
BITS = 1 << 22
#: Terms whose counts a task holds before it passes them on.
HELD = 200_000

#: ASCII letters lower-cased, other ASCII but digits as blanks: bytes.split() then gives the words.
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                 for c in range(256))


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if place % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _emails(text: str) -> list[tuple[int, int]]:
    """``EMAIL.finditer``, started at the names before each at-sign only.

    A match must hold an at-sign, and its name can only be the run of name
    characters that ends there, cut at the end of the match before.
    """
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and EMAIL_NAME.match(text, start - 1):
            start -= 1
        found = EMAIL.match(text, start) if start < at else None
        if found:
            out.append(found.span())
            done = found.end()
        at = text.find("@", max(at + 1, done))
    return out


def entities(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of the base spans, by start and kind."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if DIGITS.search(text):
        if "." in text:
            out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
                    if 9 <= len(DIGITS.findall(m[0])) <= 15]
    return sorted(out)


def is_term(word: bytes) -> bool:
    return ((word.isalpha() or not DIGIT.search(word)) and len(word) >= TERM_LENGTH
            and (len(word) >= 4 * TERM_LENGTH or len(word.decode("utf-8", "replace")) >= TERM_LENGTH))


def terms_outside(text: str, spans: list[tuple[int, int, int]]) -> set[bytes]:
    """The distinct terms among the words that overlap no span."""
    parts, at = [], 0
    for s, _, e in spans:
        while s > at and WORD.match(text, s, s + 1) and WORD.match(text, s - 1, s):
            s -= 1
        rest = WORD.match(text, e) if WORD.match(text, e - 1, e) else None
        parts.append(text[at:s])
        at = max(at, rest.end() if rest else e)
    parts.append(text[at:])
    return set(filter(is_term, " ".join(parts).encode("utf-8", "replace").translate(TO_WORDS).split()))


FOUND = ("id {id}, row_key long, n_email long, n_ip long, n_card long, n_phone long, "
         "base_sha256 string, base array<struct<start:int,kind:int,end:int>>")


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = None
    for batch in batches:
        schema = schema or pa.schema([
            ("id", batch.schema.field("id").type), ("row_key", pa.int64()),
            *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()),
            ("base", pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])))])
        for at in range(0, batch.num_rows, 256):
            out = []
            for row in batch.slice(at, 256).to_pylist():
                text = row.pop("t")
                spans = entities(text)
                counts = Counter(kind for _, kind, _ in spans)
                listed = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
                out.append(row | {f"n_{name}": counts[k] for k, name in enumerate(KINDS)} | {
                    "base_sha256": hashlib.sha256(listed.encode()).hexdigest(),
                    "base": [{"start": s, "kind": k, "end": e} for s, k, e in spans]})
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def find_entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One stored row per document row: id, row_key, counts, base spans."""
    kind = docs.schema[id_col].dataType.simpleString()
    return stored(docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row_key"),
                              whole(F.col(text_col)).alias("t"))
                  .mapInArrow(_find, FOUND.format(id=kind)), "pii")


def term_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, documents, linked): how many rows of ``docs`` hold the term and, for each kind, how many
    of them hold the kind and the term outside entities; only terms that meet a kind."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        linked: Counter = Counter()

        def out() -> pa.RecordBatch:
            terms = list(filter(is_term, held))
            place = {w: i for i, w in enumerate(terms)}
            of_kind = np.zeros((len(KINDS), len(terms)), dtype=np.int64)
            for (kind, w), n in linked.items():
                of_kind[kind, place[w]] = n
            made = {"term": pa.array([w.decode("utf-8", "replace") for w in terms], pa.string()),
                    "documents": pa.array([held[w] for w in terms], pa.int64())}
            made |= {f"n_{k}": pa.array(of_kind[i]) for i, k in enumerate(KINDS)}
            held.clear()
            linked.clear()
            return pa.RecordBatch.from_pydict(made)

        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                held.update(set(text.encode("utf-8", "replace").translate(TO_WORDS).split()))
                spans = entities(text)
                if spans:
                    words = terms_outside(text, spans)
                    for kind in {k for _, k, _ in spans}:
                        linked.update((kind, w) for w in words)
                if len(held) > HELD:
                    yield out()
        yield out()

    n = [f"n_{k}" for k in KINDS]
    return (docs.select(whole(F.col(text_col)).alias("t"))
            .mapInArrow(count, f"term string, documents long, {', '.join(f'{k} long' for k in n)}")
            .groupBy("term").agg(*[F.sum(c).alias(c) for c in ("documents", *n)])
            .where(F.greatest(*n) > 0).select("term", "documents", F.array(*n).alias("linked")))


def term_bitmap(terms: DataFrame) -> bytes:
    """``BITS`` bits, those of the terms' CRC-32 set; built by an aggregate of at most BITS / 64 rows."""
    at = F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit(BITS - 1))
    rows = (terms.select(F.shiftright(at, 6).alias("slot"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
            .groupBy("slot").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits"))
            .collect())
    words = np.zeros(BITS // 64, dtype=np.int64)
    for r in rows:
        words[r["slot"]] = r["bits"]
    return words.tobytes()


class Listed(dict):
    """Whether the bitmap holds a word; remembers the words it was asked for."""

    def __init__(self, bitmap: bytes):
        super().__init__()
        self.bits = np.frombuffer(bitmap, dtype=np.uint8)

    def __missing__(self, word: bytes) -> bool:
        if len(self) >= 2 * HELD:
            self.clear()
        at = zlib.crc32(word) & (BITS - 1)
        value = self[word] = bool(self.bits[at >> 3] >> (at & 7) & 1)
        return value


def term_places(docs: DataFrame, bitmap: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row_key, term, start, end): all places outside entities where a term of the bitmap stands."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, schema = Listed(bitmap), None
        for batch in batches:
            schema = schema or pa.schema([("id", batch.schema.field("id").type), ("row_key", pa.int64()),
                                          ("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
            for at in range(0, batch.num_rows, 256):
                out = []
                for row in batch.slice(at, 256).to_pylist():
                    text = row.pop("t")
                    words = set(text.encode("utf-8", "replace").translate(TO_WORDS).split())
                    hits = {w.decode("utf-8", "replace") for w in words if is_term(w) and listed[w]}
                    if not hits:
                        continue
                    spans, past = entities(text), 0
                    for m in WORD.finditer(text):
                        s, e = m.span()
                        word = m[0].encode("utf-8", "replace").lower().decode("utf-8")
                        if word in hits:
                            # Spans are by start: the first that has not ended before the word decides.
                            while past < len(spans) and spans[past][2] <= s:
                                past += 1
                            if past == len(spans) or spans[past][0] >= e:
                                out.append(row | {"term": word, "start": s, "end": e})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row_key"),
                        whole(F.col(text_col)).alias("t"))
            .mapInArrow(place, f"id {kind}, row_key long, term string, start int, end int"))


def evidence(linked: Column, documents: Column, share: Column) -> Column:
    """-log of the Chernoff bound of the chance that ``linked`` of ``documents`` are hit if each is with ``share``."""
    rest = documents - linked
    missed = F.when(rest > 0, rest * F.log(rest / (documents * (1 - share)))).otherwise(0.0)
    return F.when(linked > documents * share, linked * F.log(linked / (documents * share)) + missed).otherwise(0.0)


def disclosing_terms(found: DataFrame, docs: DataFrame, text_col: str = "text", alpha: float = ALPHA,
                     generalise: float = GENERALISE) -> DataFrame:
    """(kind, term, disclosure) of the terms that reach the threshold.

    Their link must lie above chance, or above the threshold where that is the lower of the two.
    """
    n = F.array(*[F.count(F.when(F.col(f"n_{k}") > 0, 1)) for k in KINDS])
    totals = found.agg(F.count("*").alias("n"), n.alias("kinds")).first()
    total = F.lit(float(totals["n"]))
    of_kind = F.element_at(F.array(*[F.lit(float(x)) for x in totals["kinds"]]), F.col("kind") + 1)
    information = F.log(total / of_kind)
    share = F.least(of_kind / total, F.exp(information * (generalise - 1)))
    links = stored(term_counts(docs, text_col), "pii-links").select(
        "term", "documents", F.posexplode("linked").alias("kind", "linked")).where(F.col("linked") > 0)
    least = math.log(max(1, links.count()) / alpha)
    disclosure = F.log(total * F.col("linked") / (F.col("documents") * of_kind)) / information
    return (links.where((information > 0) & (evidence(F.col("linked"), F.col("documents"), share) >= least))
            .select("kind", "term", disclosure.alias("disclosure"))
            .where(F.col("disclosure") >= generalise))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    return F.array_join(F.transform(F.sort_array(spans), lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def disclosures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id, row_key, counts, base_sha256, base spans, and terms, all places of
    disclosing terms (start, end, disclosure, kind of entity)."""
    found = find_entities(docs, id_col, text_col)
    terms = stored(disclosing_terms(found, docs, text_col), "pii-terms")
    marked = (term_places(docs, term_bitmap(terms.select("term").distinct()), id_col, text_col).join(terms, "term")
              .groupBy(F.col("id").alias("of_id"), F.col("row_key").alias("of_key")).agg(
                  F.collect_set(F.struct("start", F.lit(len(KINDS)).alias("kind"), "end")).alias("spans"),
                  F.collect_set(F.struct("start", "end", "disclosure", "kind")).alias("terms")))
    same = (F.col("row_key") == F.col("of_key")) & F.col("id").eqNullSafe(F.col("of_id"))
    return found.join(marked, same, "left").drop("of_id", "of_key")


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove: float = REMOVE) -> DataFrame:
    """(id, row_key, text): entities replaced by their kind, disclosing terms generalised or removed."""
    marks = disclosures(docs, id_col, text_col).where(
        (F.size("base") > 0) | F.col("terms").isNotNull()).dropDuplicates(["id", "row_key"]).select(
        F.col("id").alias("of_id"), F.col("row_key").alias("of_key"), "base", "terms")
    same = (F.col("row_key") == F.col("of_key")) & F.col("id").eqNullSafe(F.col("of_id"))
    both = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row_key"),
                       whole(F.col(text_col)).alias("t")).join(marks, same, "left").drop("of_id", "of_key")

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for row in batch.to_pylist():
                text, cuts, end = row["t"], [], 0
                for x in row["base"] or []:
                    cuts.append((x["start"], x["end"], f"<{KINDS[x['kind']].upper()}>"))
                for x in row["terms"] or []:
                    cuts.append((x["start"], x["end"],
                                 "" if x["disclosure"] >= remove else f"<{KINDS[x['kind']].upper()} TERM>"))
                parts = []
                for s, e, label in sorted(cuts):
                    if s >= end:
                        parts += [text[end:s], label]
                        end = e
                texts.append("".join([*parts, text[end:]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row_key"), pa.array(texts, pa.string())], ["id", "row_key", "text"])

    kind = docs.schema[id_col].dataType.simpleString()
    return both.mapInArrow(redact, f"id {kind}, row_key long, text string")


def pii_digest(docs: DataFrame) -> DataFrame:
    """The digest of ``op9``: one row per document."""
    d = disclosures(docs.select("doc_id", "text"))
    spans = F.concat("base", F.coalesce("spans", F.array().cast("array<struct<start:int,kind:int,end:int>>")))
    return d.select(F.col("id").alias("doc_id"), *[f"n_{k}" for k in KINDS], "base_sha256",
                    _joined(spans).alias("spans"))

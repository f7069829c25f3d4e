"""Alignment of the tokens that two tokenizers make of the same text.

Interval coalescing: the byte ranges of all tokens of A and B are sorted by
start (``lexsort``), the running maximum of their ends is taken
(``maximum.accumulate``), and a group breaks where a start reaches it. Within
the groups overlapping ranges expand to pairs; a pair whose ranges end at the
same byte is a link. Link counts are taken over the whole corpus.

Texts are tokenized once, in bounded portions, and each document leaves its
distinct links with their multiplicities in a written table. The counts are
summed in each task before the shuffle. Looking the counts up again needs no
shuffle of the documents' links for the frequent pairs: those whose number is
proven to be at most ``FREQUENT`` by a histogram of all counts (64 rows) are
broadcast; the rest meets its documents in a join, in which no key is frequent.

The tokenizers' files are read by the driver and travel with the tasks (a few
megabytes, as large as the vocabularies).

Defined results: texts that are null or empty, or of which either tokenizer's
bytes differ from the text led by a blank, have no tokens: zeros and an empty
text of groups. Special tokens in a text are plain text. Rows with null or
repeated ids each keep their row; an empty table gives an empty result. Only
the named columns are read, others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain, pairwise
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

TOKENIZERS = "/opt/tokenizers"
#: Both tokenizers see, or add, this before the text.
LEAD = " "
#: Bytes of text that a task tokenizes at a time (a longer text is a portion of its own).
PORTION = 1 << 18
#: Link counts that are broadcast at most.
FREQUENT = 250_000
#: A pair's key is the first token's id times this plus the second's.
PAIR = 1 << 32


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


#: Fixed value: the pattern by which byte-level vocabularies of this kind part a text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class ByteLevel:
    """A byte-level BPE in the JSON format of ``tokenizers``."""
    data: bytes

    def _ranks(self) -> dict[bytes, int] | None:
        """Bytes -> id, if the ids themselves order the merges and nothing else changes the text, so
        that ``tiktoken``, several times faster, makes the same tokens."""
        import json
        made = json.loads(self.data)
        model, before = made["model"], made.get("pre_tokenizer") or {}
        plain = (model.get("type") == "BPE" and not made.get("normalizer") and not model.get("ignore_merges")
                 and not model.get("dropout") and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                 and not before.get("add_prefix_space") and all(t["special"] for t in made["added_tokens"]))
        if not plain:
            return None
        alphabet, special = byte_alphabet(), {t["content"] for t in made["added_tokens"]}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        ranks = {bytes(alphabet[c] for c in entry): n for entry, n in model["vocab"].items() if entry not in special}
        ordered = all(x < y for x, y in pairwise(merged)) and len(ranks) == 256 + len(merged)
        return ranks if ordered else None

    def open(self) -> tuple[Any, list[bytes]]:
        """(texts -> lists of ids, the bytes of each id)."""
        ranks = self._ranks()
        if ranks is None:
            return self.open_general()
        from tiktoken import Encoding
        made = Encoding("byte level", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
        table = [b""] * (max(ranks.values()) + 1)
        for entry, number in ranks.items():
            table[number] = entry
        return lambda texts: [made.encode_ordinary(LEAD + t) for t in texts], table

    def open_general(self) -> tuple[Any, list[bytes]]:
        """``open`` by the library whose format it is, for every vocabulary."""
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core
        from tokenizers import Tokenizer
        made = Tokenizer.from_str(self.data.decode())
        made.encode_special_tokens = True
        alphabet = byte_alphabet()
        table = [b""] * made.get_vocab_size(with_added_tokens=True)
        for entry, number in made.get_vocab(with_added_tokens=True).items():
            known = all(c in alphabet for c in entry)
            table[number] = bytes(alphabet[c] for c in entry) if known else entry.encode()

        def encode(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in made.encode_batch_fast([LEAD + t for t in texts], add_special_tokens=False)]
        return encode, table


@dataclass(frozen=True)
class Pieces:
    """A ``sentencepiece`` model, which leads the text by a blank itself."""
    data: bytes

    def open(self) -> tuple[Any, list[bytes]]:
        """(texts -> lists of ids, the bytes of each id)."""
        from sentencepiece import SentencePieceProcessor
        made = SentencePieceProcessor(model_proto=self.data)
        table = []
        for number in range(made.get_piece_size()):
            piece = made.id_to_piece(number)
            table.append(bytes([int(piece[3:5], 16)]) if made.is_byte(number) else piece.replace("▁", " ").encode())
        return lambda texts: made.encode(texts, num_threads=1), table


def tokenizers(folder: str = TOKENIZERS) -> tuple[ByteLevel, Pieces]:
    """The two public tokenizers whose files lie in ``folder``."""
    def read(name: str) -> bytes:
        with open(f"{folder}/{name}", "rb") as f:
            return f.read()
    return ByteLevel(read("byte_bpe_50k.json")), Pieces(read("piece_bpe_32k.model"))


# --- intervals ------------------------------------------------------------------------------------

@dataclass
class Coalesced:
    """Tokens of A and B that tile the same line of bytes. Positions count from 0."""
    a_end: np.ndarray
    b_end: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    #: Every overlapping pair: positions in A and B, and whether the ranges end together.
    a_of: np.ndarray
    b_of: np.ndarray
    together: np.ndarray


def coalesce(a_len: np.ndarray, b_len: np.ndarray) -> Coalesced:
    """Groups and overlaps of two sequences of token lengths (at least one byte each)."""
    a_end, b_end = np.cumsum(a_len), np.cumsum(b_len)
    a_start, b_start = a_end - a_len, b_end - b_len
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    # Overlaps of a token of A: the tokens of B from the first that ends behind its start to the
    # last that starts before its end.
    low = np.searchsorted(b_end, a_start, "right")
    many = np.searchsorted(b_start, a_end, "left") - low
    a_of = np.repeat(np.arange(len(a_len)), many)
    b_of = np.arange(len(a_of)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
    return Coalesced(a_end, b_end, group[:len(a_len)], group[len(a_len):], a_of, b_of, a_end[a_of] == b_end[b_of])


@dataclass
class Portion:
    """Some documents, one behind the other on one line of bytes; ``at`` are their rows."""
    rows: int
    at: np.ndarray
    a: np.ndarray
    b: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    line: Coalesced


class Both:
    """Two tokenizers, opened once in each Python worker, however many tasks it runs: tasks get
    them as a broadcast value, which a worker keeps."""

    def __init__(self, first: ByteLevel | Pieces, second: ByteLevel | Pieces):
        self.first, self.second = first, second

    def __reduce__(self):
        return Both, (self.first, self.second)

    @cached_property
    def opened(self) -> list[tuple]:
        """(encoder, bytes of each id, their numbers) of each tokenizer."""
        made = [x.open() for x in (self.first, self.second)]
        return [(encode, table, np.array([len(x) for x in table], np.int64)) for encode, table in made]

    @cached_property
    def shown(self) -> np.ndarray:
        """Each id as text behind what parts it from the one before: nothing, comma, bar, semicolon."""
        top = max(len(table) for _, table, _ in self.opened)
        return np.array([[mark + str(i).encode() for i in range(top)] for mark in (b"", b",", b"|", b";")], object)


def _portion(texts: list[str | None], a_open: tuple, b_open: tuple) -> Portion:
    (a_encode, a_table, a_size), (b_encode, b_table, b_size) = a_open, b_open
    given = [i for i, t in enumerate(texts) if t]
    whole = [texts[i] for i in given]
    at, a_ids, b_ids = [], [], []
    for i, a, b in zip(given, a_encode(whole), b_encode(whole), strict=True):
        line = (LEAD + texts[i]).encode()
        if b"".join(map(a_table.__getitem__, a)) == line == b"".join(map(b_table.__getitem__, b)):
            at.append(i)
            a_ids.append(a)
            b_ids.append(b)

    def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = [len(x) for x in lists]
        ids = np.fromiter(chain.from_iterable(lists), np.int64, sum(sizes))
        return ids, np.repeat(np.arange(len(lists)), sizes)

    (a, a_doc), (b, b_doc) = flat(a_ids), flat(b_ids)
    return Portion(len(texts), np.array(at, np.int64), a, b, a_doc, b_doc,
                   coalesce(a_size[a], b_size[b]))


def _portions(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of a batch's portions."""
    begin, held, size = 0, [], 0
    for row, text in enumerate(column):
        value = text.as_py()
        if held and size + len(value or "") > PORTION:
            yield begin, held
            begin, held, size = row, [], 0
        held.append(value)
        size += len(value or "")
    if held:
        yield begin, held


def _spread(p: Portion, values: np.ndarray) -> np.ndarray:
    """Values by document as values by row; rows without tokens get 0."""
    out = np.zeros(p.rows, np.int64)
    out[p.at] = values
    return out


def _list_array(p: Portion, doc: np.ndarray, values: pa.Array) -> pa.Array:
    """Values ordered by document as a list a row."""
    size = _spread(p, np.bincount(doc, minlength=len(p.at)))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), values)


def aligned(docs: DataFrame, first: ByteLevel | Pieces, second: ByteLevel | Pieces, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per document row: its id, ``groups`` (byte range, ids of A, ids of B) and ``overlaps``
    (position in A, position in B, whether the two end together)."""
    both = docs.sparkSession.sparkContext.broadcast(Both(first, second))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_open, b_open = both.value.opened
        for batch in batches:
            for begin, texts in _portions(batch.column("text")):
                p = _portion(texts, a_open, b_open)
                line = p.line
                edges = np.arange(line.a_group[-1] + 2 if len(p.a) else 1)
                a_cut, b_cut = np.searchsorted(line.a_group, edges), np.searchsorted(line.b_group, edges)
                doc = p.a_doc[a_cut[:-1]]
                # Byte and token positions count from the document's own start.
                sizes = np.bincount(p.a_doc, weights=np.diff(line.a_end, prepend=0), minlength=len(p.at)).astype(np.int64)
                base = np.cumsum(sizes) - sizes
                a_base = np.searchsorted(p.a_doc, np.arange(len(p.at)))
                b_base = np.searchsorted(p.b_doc, np.arange(len(p.at)))
                end = line.a_end[a_cut[1:] - 1]
                start = np.concatenate([[0], end[:-1]]) if len(end) else end

                def ids(values: np.ndarray, cut: np.ndarray) -> pa.Array:
                    return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(values, pa.int32()))

                groups = pa.StructArray.from_arrays(
                    [pa.array(start - base[doc], pa.int64()), pa.array(end - base[doc], pa.int64()), ids(p.a, a_cut),
                     ids(p.b, b_cut)], ["start", "end", "a", "b"])
                over = p.a_doc[line.a_of]
                pairs = pa.StructArray.from_arrays(
                    [pa.array(line.a_of - a_base[over], pa.int32()), pa.array(line.b_of - b_base[over], pa.int32()),
                     pa.array(line.together)], ["a", "b", "together"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(begin, p.rows), _list_array(p, doc, groups), _list_array(p, over, pairs)],
                    ["id", "groups", "overlaps"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(align, f"id {kind}, groups array<struct<start:long,end:long,a:array<int>,b:array<int>>>, "
                               "overlaps array<struct<a:int,b:int,together:boolean>>"))


# --- links and their counts -----------------------------------------------------------------------

LINKS = ("row long, id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "pairs array<long>, times array<long>")


def links(docs: DataFrame, first: ByteLevel | Pieces, second: ByteLevel | Pieces, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document row: tokens, groups (also as a digest) and links, and the document's
    distinct links, ``PAIR`` times A's id plus B's, with how often each stands in it. A written table."""
    both = docs.sparkSession.sparkContext.broadcast(Both(first, second))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_open, b_open = both.value.opened
        shown = both.value.shown
        for batch in batches:
            for begin, texts in _portions(batch.column("text")):
                p = _portion(texts, a_open, b_open)
                line, docs_here = p.line, len(p.at)
                group = np.concatenate([line.a_group, line.b_group])
                kind = np.repeat([0, 1], [len(p.a), len(p.b)])
                order = np.lexsort((kind, group))  # stable: tokens keep their order
                ids, group, kind = np.concatenate([p.a, p.b])[order], group[order], kind[order]
                doc = np.concatenate([p.a_doc, p.b_doc])[order]
                mark = np.ones(len(ids), np.int64)
                mark[1:][kind[1:] != kind[:-1]] = 2
                mark[1:][group[1:] != group[:-1]] = 3
                cut = np.searchsorted(doc, np.arange(docs_here + 1))
                mark[cut[:-1]] = 0
                words = shown[mark, ids]
                digests = [""] * p.rows
                for k, row in enumerate(p.at.tolist()):
                    digests[row] = hashlib.sha256(b"".join(words[cut[k]:cut[k + 1]].tolist())).hexdigest()
                key = (p.a[line.a_of] * PAIR + p.b[line.b_of])[line.together]
                held = p.a_doc[line.a_of][line.together]
                order = np.lexsort((key, held))
                key, held = key[order], held[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (held[1:] != held[:-1])
                place = np.flatnonzero(new)
                times = np.diff(np.append(place, len(key)))
                per = [np.bincount(x, minlength=docs_here) for x in (p.a_doc, p.b_doc)]
                groups = np.bincount(doc[np.flatnonzero(mark != 1)][kind[mark != 1] == 0], minlength=docs_here)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(begin, p.rows), batch.column("id").slice(begin, p.rows),
                     *[pa.array(_spread(p, x)) for x in (*per, groups, np.bincount(held, minlength=docs_here))],
                     pa.array(digests, pa.string()), _list_array(p, held[place], pa.array(key[place], pa.int64())),
                     _list_array(p, held[place], pa.array(times, pa.int64()))],
                    ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    return stored(rows.mapInArrow(count, LINKS.format(id=kind)), "token-links", compression="zstd")


def _pairs(linked: DataFrame) -> DataFrame:
    return linked.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")


def pair_counts(linked: DataFrame) -> DataFrame:
    """``pair``, how many links of the corpus hold it (``n``), and whether no other first token is
    linked more often with its second one (``best``). A written table."""
    counts = _pairs(linked).groupBy("pair").agg(F.sum("times").alias("n"))
    # As many rows a window as the first vocabulary has tokens, at most.
    of_second = Window.partitionBy(F.pmod("pair", F.lit(PAIR)))
    return stored(counts.withColumn("best", F.col("n") == F.max("n").over(of_second)), "token-pairs")


def frequent_from(counts: DataFrame, most: int = FREQUENT) -> tuple[int, int]:
    """The lowest power of two that at most ``most`` pairs' counts reach, and how many pairs lie below it."""
    level = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    steps = {r["level"]: r["pairs"] for r in counts.groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("pairs")).collect()}
    below, lowest = sum(steps.values()), 63
    for step in range(62, -1, -1):
        if sum(steps.values()) - below + steps.get(step, 0) > most:
            break
        below, lowest = below - steps.get(step, 0), step
    return 1 << lowest, below


def link_sums(linked: DataFrame, counts: DataFrame, most: int = FREQUENT) -> DataFrame:
    """By document row: ``count_sum`` of its links' counts, and ``n_best`` of its links."""
    least, rare = frequent_from(counts, most)
    frequent = F.broadcast(counts.where(F.col("n") >= least))

    def by_row(joined: DataFrame) -> DataFrame:
        return joined.groupBy("row").agg(
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"))

    sums = by_row(_pairs(linked).join(frequent, "pair"))
    if not rare:
        return sums
    others = _pairs(linked).join(frequent.select("pair"), "pair", "left_anti")
    rest = by_row(others.join(counts.where(F.col("n") < least), "pair"))
    return sums.unionByName(rest).groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))


def alignment_digest(documents: DataFrame, folder: str = TOKENIZERS, most: int = FREQUENT) -> DataFrame:
    """The digest of ``op13``: one row per document row."""
    first, second = tokenizers(folder)
    linked = links(documents.select("doc_id", "text"), first, second)
    sums = link_sums(linked, pair_counts(linked), most)
    zero = F.lit(0).cast("long")
    return linked.drop("pairs", "times").join(sums, "row", "left").select(
        F.col("id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")

"""Compression of vectors into short codes, one codebook a slice of the vector.

Vectors are cut into equal consecutive slices ("parts"); a part is replaced by
the number of its nearest codebook entry. The search for that entry is slice
and intersect: per dimension the entries' coordinates are sorted, and every
prefix of that order carries a bit mask of its entries. The distance to an
entry that is close along one dimension gives a radius that the nearest one
cannot exceed; the coordinates within the radius are a range a dimension, a
range is the difference of two prefix masks, and the AND of the ranges' uint64
masks holds every entry that can be nearest. Only those are measured, so the
result is exact.

One scan of the vectors a training round and one that writes the codes; a task
sends one sum an entry to the shuffle, and the driver holds the codebooks
(``entries`` times the vector's length of numbers), which travel with the tasks.

Defined results: vectors that are null or hold null or non-finite components
are dropped. The length is that of the first vector, by id, which ``parts``
divides; kept vectors of another length, and those whose distances would not
fit into a long (components beyond about 700,000 at 64 dimensions), have no
code: nulls. Equal distances take the lower entry, equal ids sort by their
vector, null ids last. Fewer vectors than entries make smaller codebooks; an
empty table gives an empty result. Repeated rows count and come out as often
as they stand. Only the named columns are read, others cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Components are kept as whole multiples of 1 / SCALE.
SCALE = 256
#: Buckets over which the rows of one label meet its sum.
SALT = 16
#: Numbers that a task works on at a time.
BLOCK = 1 << 20


class SliceSearch:
    """Nearest entry of one codebook, by masks over sorted coordinates."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        k, dims = entries.shape
        self.words = (k + 63) // 64
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = [entries[self.order[:, d], d] for d in range(dims)]
        self.prefix = []
        for d in range(dims):
            bits = np.zeros((k + 1, self.words), np.uint64)
            bits[np.arange(1, k + 1), self.order[:, d] // 64] = np.uint64(1) << (self.order[:, d] % 64).astype(np.uint64)
            self.prefix.append(np.bitwise_or.accumulate(bits, axis=0))

    def _distance(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        apart = x - self.entries[which]
        return (apart * apart).sum(axis=1)

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """Masks of the entries within a radius that the nearest entry does not exceed."""
        near = None
        for d, line in enumerate(self.sorted):
            at = np.minimum(np.searchsorted(line, x[:, d]), len(line) - 1)
            found = self._distance(x, self.order[at, d])
            near = found if near is None else np.minimum(near, found)
        radius = np.ceil(np.sqrt(near)).astype(np.int64) + 1
        masks = np.full((len(x), self.words), ~np.uint64(0))
        for d, line in enumerate(self.sorted):
            low = np.searchsorted(line, x[:, d] - radius, "left")
            high = np.searchsorted(line, x[:, d] + radius, "right")
            masks &= self.prefix[d][high] ^ self.prefix[d][low]
        return masks

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row; the lower entry of equal ones."""
        masks = self.candidates(x)
        best = np.full(len(x), np.iinfo(np.int64).max)
        entry = np.zeros(len(x), np.int64)
        for word in range(self.words):
            rows = np.flatnonzero(masks[:, word])
            mask = masks[rows, word]
            while rows.size:  # the lowest bit of each mask that is left, so entries come in order
                lowest = mask & (~mask + np.uint64(1))
                which = word * 64 + np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)
                found = self._distance(x[rows], which)
                better = found < best[rows]
                best[rows[better]] = found[better]
                entry[rows[better]] = which[better]
                mask ^= lowest
                left = mask != 0
                rows, mask = rows[left], mask[left]
        return entry, best


@dataclass
class Codebooks:
    """``entries[part][entry]`` are whole numbers; ``width`` components a part."""
    entries: np.ndarray  # parts x entries x width

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    @property
    def dims(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    @property
    def limit(self) -> int:
        """Components up to this size keep every distance of whole vectors below 2**63."""
        return math.isqrt((2 ** 63 - 1) // max(self.dims, 1)) // 2

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()

    def assign(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes: rows x parts, squared distances summed over parts)."""
        codes = np.empty((len(numbers), self.parts), np.uint8)
        error = np.zeros(len(numbers), np.int64)
        width = self.entries.shape[2]
        for part in range(self.parts):
            entry, far = SliceSearch(self.entries[part]).nearest(numbers[:, part * width:(part + 1) * width])
            codes[:, part] = entry
            error += far
        return codes, error

    def decode(self, code: str) -> list[float]:
        """The vector that a code stands for: the middles of its entries' steps."""
        at = bytes.fromhex(code)
        return [(int(c) + 0.5) / SCALE for part, entry in enumerate(at) for c in self.entries[part, entry]]


def kept(vector: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(False))


def _narrow(df: DataFrame, id_col: str, vec_col: str, carry: Sequence[str] = ()) -> DataFrame:
    vector = F.col(f"`{vec_col}`").cast("array<double>")
    return (df.select(F.col(f"`{id_col}`").alias("id"), vector.alias("vec"),
                      *[F.col(f"`{c}`").alias(f"carry_{i}") for i, c in enumerate(carry)])
            .where(kept(F.col("vec"))))


def _blocks(column: pa.Array, dims: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their components as whole numbers) of a batch's vectors that have a code, a block at a time."""
    step = max(1, BLOCK // max(dims, 1))
    for begin in range(0, len(column), step):
        piece = column.slice(begin, step)
        fit = np.flatnonzero(piece.value_lengths().to_numpy(zero_copy_only=False) == dims)
        if not len(fit):
            continue
        piece = piece.take(pa.array(fit))
        scaled = (SCALE * piece.flatten().to_numpy(zero_copy_only=False)).reshape(len(fit), dims)
        small = (np.abs(scaled) <= limit).all(axis=1)
        if small.any():
            yield begin + fit[small], np.floor(scaled[small]).astype(np.int64)


def start(df: DataFrame, id_col: str, vec_col: str, parts: int, entries: int) -> Codebooks:
    """Codebooks of the vectors with the smallest ids: ``entries`` rows reach the driver."""
    rows = _narrow(df, id_col, vec_col).where((F.size("vec") > 0) & (F.size("vec") % parts == 0))
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "vec")
    first = rows.agg(F.min_by(F.size("vec"), order).alias("dims")).first()["dims"]
    if first is None:
        return Codebooks(np.zeros((parts, 0, 1), np.int64))
    limit = Codebooks(np.zeros((parts, 0, first // parts), np.int64)).limit
    fit = rows.where((F.size("vec") == first) & ~F.exists("vec", lambda x: F.abs(x * SCALE) > limit))
    seeds = fit.orderBy(F.col("id").isNull(), "id", "vec").limit(entries).collect()
    numbers = np.array([[math.floor(SCALE * x) for x in r["vec"]] for r in seeds], np.int64).reshape(len(seeds), first)
    return Codebooks(np.ascontiguousarray(numbers.reshape(len(seeds), parts, first // parts).transpose(1, 0, 2)))


def improve(df: DataFrame, books: Codebooks, id_col: str, vec_col: str) -> Codebooks:
    """One round: every part goes to its nearest entry, every entry to the floor of its parts' mean.

    A task sends one row an entry that it met; the sums that reach the driver are as large as
    the codebooks.
    """
    width = books.entries.shape[2]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(books.entries.shape, np.int64)
        count = np.zeros(books.entries.shape[:2], np.int64)
        for batch in batches:
            for _, numbers in _blocks(batch.column(0), books.dims, books.limit):
                codes, _ = books.assign(numbers)
                for part in range(books.parts):
                    np.add.at(total[part], codes[:, part], numbers[:, part * width:(part + 1) * width])
                    count[part] += np.bincount(codes[:, part], minlength=count.shape[1])
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry], pa.int64()),
             pa.array(list(total[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "total"])

    if not books.entries.size:
        return books
    met = (_narrow(df, id_col, vec_col).select("vec")
           .mapInArrow(sums, "part int, entry int, n long, total array<long>")
           .groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(
               *[F.sum(F.col("total")[i]) for i in range(width)]).alias("total")).collect())
    better = books.entries.copy()
    for r in met:
        better[r["part"], r["entry"]] = [t // r["n"] for t in r["total"]]
    return Codebooks(better)


def train(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", parts: int = PARTS,
          entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of all kept vectors."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: 1 to 256 entries")
    books = start(df, id_col, vec_col, parts, entries)
    for _ in range(rounds):
        books = improve(df, books, id_col, vec_col)
    return books


def encode(df: DataFrame, books: Codebooks, id_col: str = "vec_id", vec_col: str = "embedding",
           carry: Sequence[str] = ()) -> DataFrame:
    """One row per kept vector: its id, the carried columns, ``code`` (two hexadecimal digits a
    part) and ``error`` (squared distance to the vector that the code stands for)."""
    rows = _narrow(df, id_col, vec_col, carry)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = [None] * batch.num_rows, [None] * batch.num_rows
            if books.entries.size:
                for which, numbers in _blocks(batch.column("vec"), books.dims, books.limit):
                    found, far = books.assign(numbers)
                    for row, c, e in zip(which.tolist(), found, far.tolist(), strict=True):
                        code[row], error[row] = c.tobytes().hex(), e
            others = [i for i, n in enumerate(batch.schema.names) if n != "vec"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in others], pa.array(code, pa.string()), pa.array(error, pa.int64())],
                [*[batch.schema.names[i] for i in others], "code", "error"])

    kinds = [(f.name, f.dataType.simpleString()) for f in rows.schema.fields if f.name != "vec"]
    schema = ", ".join(f"`{n}` {k}" for n, k in [*kinds, ("code", "string"), ("error", "bigint")])
    coded = rows.mapInArrow(codes, schema)
    return coded.select(F.col("id").alias(id_col), *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)],
                        "code", "error")


def code_digest(embeddings: DataFrame) -> DataFrame:
    """The digest of ``op11``: one row per kept vector.

    A label's sum meets its rows over ``SALT`` buckets, so a label that a third of the rows carry
    is no single task.
    """
    rows = embeddings.select("vec_id", "embedding", "label")
    books = train(rows)
    coded = stored(encode(rows, books, carry=["label"]), "vector-codes")
    totals = (coded.groupBy("label").agg(F.try_sum("error").alias("label_error"))
              .select(F.col("label").alias("of"), "label_error",
                      F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("bucket")))
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code", "error"), F.lit(SALT)).cast("int"))
    joined = salted.join(totals, salted["label"].eqNullSafe(totals["of"]) & (salted["salt"] == totals["bucket"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))

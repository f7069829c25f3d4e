"""Near-duplicate classes by HyperMinHash sketches, banding and exact verification.

A document's set is its distinct 5-word shingles (64-bit hashes). Its sketch
has 128 buckets: the leading bits of a shingle's hash choose the bucket, and
the bucket stores the smallest remaining value as a 16-bit register, six bits
of leading-zero count and ten bits of mantissa. Empty buckets (short texts)
borrow from another bucket chosen by a fixed probe sequence.

1. Documents with equal sets form a class (128-bit set digest, combined before
   the shuffle); one member stands for the class from here on.
2. Registers are banded, four to a band. Documents of a band bucket are
   candidates. With 32 bands, a pair at similarity 0.75 shares none with a
   chance of 5e-6.
3. Buckets are not expanded to pairs. First, every member of a bucket is
   compared with its first one. The registers give a Jaccard estimate, corrected
   for chance register collisions; pairs within five standard deviations of the
   threshold are verified on their full sets, and verified links merge
   components. Left open are members outside the largest component of their
   bucket. They are gathered by that component, and blocks of them, of bounded
   size, meet the stream of all members of its buckets: registers first, then
   full sets, best estimates first, until a member is linked to a component or
   no candidate is left. Rounds go on while a largest component changes, so no
   pair of a bucket that lies across components stays uncompared; pairs inside
   a component need no comparison, as classes and components are the result.
4. Verification streams: a pivot's set is followed by its partners' sets in
   one sorted partition. A pivot with many partners is dealt over several
   chunks, each of which gets the pivot's set. Memory: two sets.

Components come from label propagation with pointer jumping on tables in the
shared folder; nothing of the corpus is collected.

Defined results: texts that are null or without words have an empty set, are
linked with nothing and are their own component; texts of fewer than five
words have one shingle, the whole sequence; equal sets are linked whatever
their ids; repeated rows give repeated rows; a component's id is its smallest
non-null document id (null if it has none); empty tables give empty results;
only the id and text columns are read, others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, free_name, row_key, stored

SHINGLE = 5
BUCKETS = 128
BUCKET_BITS = 7
REST_BITS = 64 - BUCKET_BITS
MANTISSA_BITS = 10
ROWS = 4
BANDS = BUCKETS // ROWS
#: Similarity in percent, and the standard deviations of an estimate by which it may miss it.
PERCENT = 75
DEVIATIONS = 5
#: Shingles of the open members in a block (8 bytes each), and members that a block meets in one task.
BLOCK = 1 << 20
STREAM = 16384
#: Partners that share one copy of their pivot's set.
CHUNK = 256
#: Rows that a Python worker gets at a time.
ARROW_ROWS = 1000
#: Words whose hash a Python worker remembers.
REMEMBERED = 100_000

_U = np.uint64
_COEFFICIENTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                          0xA0761D6478BD642F], dtype=_U)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit (the public splitmix64 constants)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes(dict):
    """64-bit word hashes, remembered for the words met last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def shingle_set(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles of a UTF-8 text (A-Z lower-cased)."""
    words = text.lower().split()  # of bytes: ASCII letters, and blanks 0x20 and 0x09-0x0D
    n = len(words)
    if not n:
        return np.empty(0, dtype=_U)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=_U, count=n)
    with np.errstate(over="ignore"):
        if n < SHINGLE:
            return _mix(np.sum(h * _COEFFICIENTS[:n], keepdims=True, dtype=_U) + _U(n))
        m = n - SHINGLE + 1
        s = h[:m] * _COEFFICIENTS[0]
        for j in range(1, SHINGLE):
            s = s + h[j:m + j] * _COEFFICIENTS[j]
        return np.unique(_mix(s))


def _probes() -> np.ndarray:
    """For each bucket the order in which it looks for another one to borrow from."""
    order = np.random.default_rng(20240229)
    return np.stack([order.permutation(BUCKETS) for _ in range(BUCKETS)]).astype(np.int16)


PROBES = _probes()


def registers(s: np.ndarray) -> np.ndarray:
    """The 128 HyperMinHash registers (uint16) of a sorted, non-empty set."""
    bucket = (s >> _U(REST_BITS)).astype(np.int64)
    first = np.searchsorted(bucket, np.arange(BUCKETS))
    filled = np.zeros(BUCKETS, dtype=bool)
    filled[bucket] = True
    rest = s[np.minimum(first, len(s) - 1)] & _U((1 << REST_BITS) - 1)
    # Leading zeros of the 57-bit rest; frexp is exact enough on its top 53 bits.
    top = (rest >> _U(REST_BITS - 53)).astype(np.float64)
    length = np.frexp(top)[1]
    zeros = 53 - length
    shift = np.maximum(length - 1 - MANTISSA_BITS + (REST_BITS - 53), 0).astype(_U)
    mantissa = (rest >> shift) & _U((1 << MANTISSA_BITS) - 1)
    out = (np.minimum(zeros, 63).astype(np.uint16) << np.uint16(MANTISSA_BITS)) | mantissa.astype(np.uint16)
    if not filled.all():
        empty = np.flatnonzero(~filled)
        probes = PROBES[empty]
        donor = probes[np.arange(len(empty)), filled[probes].argmax(axis=1)]
        out[empty] = out[donor]
    return out


def bands(regs: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band: its four registers mixed with the band's number."""
    packed = np.ascontiguousarray(regs.reshape(BANDS, ROWS)).view(_U).ravel()
    with np.errstate(over="ignore"):
        return _mix(packed + _mix(np.arange(1, BANDS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))).view(np.int64)


def chance_collision(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Chance that two registers of unrelated sets of these sizes agree."""
    k = np.arange(0, 40)
    shares = []
    for n in (n_a, n_b):
        load = np.maximum(np.asarray(n, dtype=float) / BUCKETS, 1.0)[:, None]
        # The smallest of `load` uniform values has k leading zeros.
        shares.append((1 - 0.5 ** (k + 1)) ** load - np.where(k > 0, (1 - 0.5 ** k), 0.0) ** load)
    return (shares[0] * shares[1]).sum(axis=1) / (1 << MANTISSA_BITS)


def estimate(regs_a: np.ndarray, regs_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of pairs of register rows, corrected for chance collisions."""
    agree = (regs_a == regs_b).mean(axis=1)
    chance = chance_collision(n_a, n_b)
    return np.clip((agree - chance) / (1 - chance), 0.0, 1.0)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = shared(a, b)
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


SKETCH = "row_key long, id {id}, n_shingles long, digest binary, registers binary, bands array<bigint>"


def _rows(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[list[dict]]:
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step).to_pylist()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    schema = None
    for batch in batches:
        # An idle worker keeps what its allocator holds: give it back between batches.
        pa.default_memory_pool().release_unused()
        schema = schema or pa.schema([("row_key", pa.int64()), ("id", batch.schema.field("id").type),
                                      ("n_shingles", pa.int64()), ("digest", pa.binary()),
                                      ("registers", pa.binary()), ("bands", pa.list_(pa.int64()))])
        for rows in _rows([batch]):
            out = []
            for row in rows:
                s = shingle_set(row["t"] or b"", hashes)
                made = {"row_key": row["row_key"], "id": row["id"], "n_shingles": len(s)}
                if len(s):
                    regs = registers(s)
                    made |= {"digest": hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                             "registers": regs.tobytes(), "bands": bands(regs).tolist()}
                out.append(made)
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: row_key, id, set size, set digest, registers and band keys."""
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(row_key(id_col, text_col).alias("row_key"), F.col(id_col).alias("id"),
                        F.col(text_col).cast("string").cast("binary").alias("t"))
            .mapInArrow(_sketch, SKETCH.format(id=kind)))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    schema = pa.schema([("node", pa.int64()), ("set", pa.binary())])
    for rows in _rows(batches):
        out = []
        for row in rows:
            s = shingle_set(row["t"] or b"", hashes).tobytes()
            if hashlib.blake2b(s, digest_size=16).digest() == row["digest"]:  # not another text with its key
                out.append({"node": row["node"], "set": s})
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def likely(agree: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether a pair with this share of equal registers may reach the threshold."""
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    filled = BUCKETS * (1 - np.exp(-small / BUCKETS))  # registers that are not borrowed
    slack = DEVIATIONS * np.sqrt(PERCENT / 100 * (1 - PERCENT / 100) / filled)
    chance = chance_collision(n_a, n_b)
    good = (agree - chance) / (1 - chance) >= PERCENT / 100 - slack
    return good & (100 * small >= PERCENT * large)  # else the sizes alone rule it out


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            agree = (_registers(batch.column("regs_a")) == _registers(batch.column("regs_b"))).mean(axis=1)
            good = likely(agree, batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy())
            yield batch.select(["a", "b"]).filter(pa.array(good))


class _Block:
    """Open members around a component, and the components each is linked to by now."""

    def __init__(self):
        self.nodes: list[int] = []
        self.sets: list[np.ndarray] = []
        self.registers: list[np.ndarray] = []
        self.linked: list[set] = []

    def add(self, nodes: list[int], comps: list[int], sets: list[np.ndarray], regs: np.ndarray) -> None:
        self.nodes += nodes
        self.sets += sets
        self.registers += list(regs)
        self.linked += [{c} for c in comps]

    def meet(self, nodes: list[int], comps: np.ndarray, sets: list[np.ndarray], regs: np.ndarray
             ) -> Iterator[tuple[int, int]]:
        """Links found with these members, one for each component at most."""
        sizes = np.array([len(x) for x in sets])
        for node, own, own_regs, linked in zip(self.nodes, self.sets, self.registers, self.linked, strict=True):
            other = np.flatnonzero(~np.isin(comps, list(linked)))
            if not len(other):
                continue
            agree = (regs[other] == own_regs).mean(axis=1)
            good = likely(agree, np.full(len(other), len(own)), sizes[other])
            for i in other[good][np.argsort(-agree[good], kind="stable")].tolist():
                comp = int(comps[i])
                if comp not in linked and similar(own, sets[i]):
                    linked.add(comp)
                    yield node, nodes[i]


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by component, block and part of the stream, open members before the others."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    key, block = None, _Block()
    for whole_batch in batches:
        for at in range(0, whole_batch.num_rows, 1024):
            batch = whole_batch.slice(at, 1024)
            keys = np.stack([batch.column(c).to_numpy() for c in ("main", "block", "part", "kind")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            regs = _registers(batch.column("registers"))
            nodes, comps = batch.column("node").to_pylist(), batch.column("comp").to_numpy()
            sets = [np.frombuffer(x, dtype=_U) for x in batch.column("set").to_pylist()]
            found = []
            for low, high in zip(cuts, cuts[1:], strict=False):
                if tuple(keys[low][:3]) != key:
                    key, block = tuple(keys[low][:3]), _Block()
                if keys[low][3] == 0:
                    block.add(nodes[low:high], comps[low:high].tolist(), sets[low:high], regs[low:high])
                else:
                    found += block.meet(nodes[low:high], comps[low:high], sets[low:high], regs[low:high])
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found], schema=schema)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted: a pivot's set, then the sets of its partners."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    pivot, own = None, None
    for rows in _rows(batches):
        out = []
        for row in rows:
            s = np.frombuffer(row["set"], dtype=_U)
            if row["partner"] is None:
                pivot, own = row["pivot"], s
            elif row["pivot"] == pivot and similar(own, s):
                out.append({"a": pivot, "b": row["partner"]})
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """(node, comp) of the nodes of ``edges`` (a, b): the smallest node each one reaches."""
    both = stored(edges.union(edges.select("b", "a")).distinct(), purpose + "-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                    .select("node", F.least("node", "low").alias("comp")), purpose + "-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        # Take the smallest label around, then the label of that label (pointer jumping).
        taken = labels.join(near, "node").select(
            "node", F.col("comp").alias("old"), F.least("comp", "near").alias("low"))
        jumped = (taken.join(labels.select(F.col("node").alias("low"), F.col("comp").alias("far")), "low", "left")
                  .select("node", F.coalesce("far", "low").alias("comp"), "old"))
        new = stored(jumped, purpose + "-labels")
        if new.where(F.col("comp") != F.col("old")).isEmpty():
            return new.select("node", "comp")
        labels = new.select("node", "comp")


def _passing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose registers let them reach the threshold."""
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"),
                                        F.col("registers").alias(f"regs_{side}")), side)
    return (pairs.select("a", "b", "n_a", "n_b", "regs_a", "regs_b")
            .mapInArrow(_estimated, "a long, b long"))


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a pivot, b partner) that are similar on their full sets."""
    pairs = stored(pairs, "pairs")
    chunks = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    partners = (pairs.join(chunks, "a")
                .select(F.col("a").alias("pivot"), F.pmod(F.xxhash64("b"), "chunks").cast("int").alias("chunk"),
                        F.col("b").alias("partner"))
                .join(sets.withColumnRenamed("node", "partner"), "partner")
                .select("pivot", "chunk", "partner", "set"))
    own = (chunks.join(sets.withColumnRenamed("node", "a"), "a")
           .select(F.col("a").alias("pivot"),
                   F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                   F.lit(None).cast("long").alias("partner"), "set"))
    rows = partners.unionByName(own)
    return (rows.repartition("pivot", "chunk")
            .sortWithinPartitions("pivot", "chunk", F.col("partner").asc_nulls_first())
            .mapInArrow(_verified, "a long, b long"))


def _met_links(open_: DataFrame, stream: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) between open members and the other members around the same component.

    Both come as (main, node, comp); ``nodes`` has the size, registers and set of every node.
    """
    sized = open_.join(nodes.select("node", "n_shingles"), "node")
    shape = (stream.groupBy("main").agg(F.ceil(F.count("*") / STREAM).cast("int").alias("parts"))
             .join(sized.groupBy("main").agg(F.ceil(F.sum("n_shingles") / BLOCK).cast("int").alias("blocks")), "main"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = (open_.join(shape, "main")
            .select("main", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"),
                    every("parts").alias("part"), F.lit(0).alias("kind"), "node", "comp")
            .unionByName(stream.join(shape, "main").select(
                "main", every("blocks").alias("block"), F.pmod(F.xxhash64("node", F.lit(1)), "parts").cast("int").alias("part"),
                F.lit(1).alias("kind"), "node", "comp")))
    return (rows.join(nodes, "node").select("main", "block", "part", "kind", "node", "comp", "registers", "set")
            .repartition("main", "block", "part").sortWithinPartitions("main", "block", "part", "kind")
            .mapInArrow(_met, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id, row_key, n_shingles, node (its class), component, component_id.

    ``node`` and ``component`` are null for empty sets. The rows lie in the
    shared folder.
    """
    with arrow_rows(docs.sparkSession, ARROW_ROWS):
        return _near_duplicates(docs, id_col, text_col)


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = stored(sketch(docs, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()), "sketch")
    worded = rows.where("n_shingles > 0")
    classes = stored(worded.groupBy("digest").agg(F.min("uid").alias("node"), F.min("id").alias("least")), "classes")
    # One row stands for each class.
    nodes = stored(worded.join(classes.select(F.col("node").alias("uid")), "uid", "left_semi")
                   .select(F.col("uid").alias("node"), "row_key", "digest", "n_shingles", "registers", "bands"),
                   "nodes")
    banded = nodes.select("node", F.explode("bands").alias("band"))
    active = (banded.groupBy("band").agg(F.min("node").alias("first"), F.max("node").alias("last"))
              .where("first <> last"))
    members = stored(banded.join(active.select("band", "first"), "band"), "members")
    ids = members.select("node").distinct()
    found = nodes.join(ids, "node", "left_semi")
    texts = (docs.select(row_key(id_col, text_col).alias("row_key"),
                         F.col(text_col).cast("string").cast("binary").alias("t")))
    sets = stored(texts.join(found.select("row_key", "node", "digest"), "row_key")
                  .select("node", "digest", "t").mapInArrow(_sets, "node long, set binary")
                  .dropDuplicates(["node"]), "sets")
    busy = stored(found.select("node", "n_shingles", "registers"), "busy")

    pairs = members.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    edges = stored(_linked(_passing(pairs, busy), sets), "links")
    full = busy.join(sets, "node")
    done = members.where("node = first").select("band", "node")
    while True:
        labels = components(edges, "round")
        placed = members.select("band", "node").join(labels, "node", "left").select(
            "band", "node", F.coalesce("comp", "node").alias("comp"))
        counts = placed.groupBy("band", "comp").agg(F.count("*").alias("n"))
        main = (counts.groupBy("band").agg(F.max(F.struct("n", "comp")).alias("main"), F.count("*").alias("comps"))
                .where("comps > 1").select("band", F.col("main.comp").alias("main")))
        placed = stored(placed.join(main, "band"), "placed")
        # Members outside the largest component of their bucket that have not met it.
        open_ = stored(placed.where("comp <> main").join(done, ["band", "node"], "left_anti"), "open")
        if open_.isEmpty():
            break
        around = placed.join(open_.select("band").distinct(), "band", "left_semi")
        edges = stored(edges.union(_met_links(*[x.select("main", "node", "comp").distinct() for x in (open_, around)],
                                              full)), "links")
        done = stored(done.union(open_.select("band", "node")), "done")
    linked = (classes.join(labels, "node", "left")
              .select("digest", "node", F.coalesce("comp", "node").alias("component"), "least"))
    smallest = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = linked.select("digest", "node", "component").join(smallest, "component")
    return (rows.select("row_key", "id", "n_shingles", "digest").join(linked, "digest", "left")
            .select(F.col("id").alias(id_col), "row_key", "n_shingles", "node", "component",
                    F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
                    .alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: its smallest id, and of rows with that id the
    one with the smallest key. Documents without words all stay."""
    found = near_duplicates(docs, id_col, text_col).where("component is not null")
    kept = (found.groupBy("component").agg(F.min(F.struct(
        F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "row_key")).alias("x"))
        .select(F.col("x.row_key").alias("kept_key"), F.col("x.id").alias("kept_id")))
    empty = ~F.coalesce(F.col(text_col).cast("string"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    key = free_name(docs, "__row_key")
    keyed = docs.withColumn(key, row_key(id_col, text_col))
    # A key may belong to two rows of a large corpus; it names one together with the id.
    same = (keyed[key] == kept["kept_key"]) & keyed[id_col].eqNullSafe(kept["kept_id"])
    worded = keyed.where(~empty).join(kept, same, "left_semi").dropDuplicates([key, id_col])
    return worded.unionByName(keyed.where(empty)).drop(key)


def neardup_digest(docs: DataFrame) -> DataFrame:
    """The digest of ``op8``: one row per document."""
    return near_duplicates(docs.select("doc_id", "text")).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))

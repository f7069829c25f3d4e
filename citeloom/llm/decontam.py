"""Benchmark decontamination by winnowing (DataFrame functions only).

A text's fingerprints are the smallest hashes of its k-word grams in every
window of ``window - k + 1`` consecutive grams, i.e. of every ``window``
consecutive words; the leftmost of equal ones, so that two equal windows of
words choose the same gram, and no shared span of ``window`` words or more can
be missed. Training and test fingerprints are joined on the 64-bit hash; each
pair is verified and extended word by word to both sides, as far as a window
that holds the gram can reach, and is a hit if the span has ``window`` words.

The test fingerprints also fill a bitmap, sized by their number (about 16 bits
each, at most 32 MB). Each document drops, inside its own row, the fingerprints
that are not in it, so that only hits and the bitmap's few false positives
leave the row, with the words around them. They are written once (below
``spark.checkpoint.dir``); the join deals each fingerprint over ``SALTS``
buckets, as a third of all documents may share a passage, and documents
without any take no part in it.

Items with fewer than ``window`` words are one window of their own length; a
pass for each such length (at most ``window - 1``) compares every gram of that
length.

Defined results: null texts have no words; a document without words is not
contaminated; items with null text or without words match nothing; null item
ids count as hits but not as items; repeated rows give repeated rows; null ids
pass through; empty tables give no hits. Only the id and text columns are
read, others cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, ascii_lower, row_key, starts, stored, whole

K = 8
WINDOW = 10
#: Longs of the bitmap, at least and at most.
SLOTS_LEAST = 1 << 10
SLOTS_MOST = 1 << 22
#: Buckets over which the documents of one fingerprint meet its items.
SALTS = 16


def _gram(words: Column, i: Column, length: int) -> Column:
    return F.concat_ws(" ", F.slice(words, i + 1, length))


def _gram_hashes(words: Column, k: int) -> Column:
    return F.transform(starts(words, k), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))


def _winnow(hashes: Column, grams: int) -> Column:
    """The smallest of every ``grams`` consecutive hashes."""
    if grams == 1:
        return hashes
    return F.transform(starts(hashes, grams), lambda i: F.least(*[F.get(hashes, i + j) for j in range(grams)]))


def _chosen(hashes: Column, fp: Column, i: Column, grams: int) -> Column:
    """Place of the gram whose hash is the smallest of those from place ``i``: the leftmost."""
    place = i + (grams - 1)
    for j in reversed(range(grams - 1)):
        place = F.when(F.get(hashes, i + j) == fp, i + j).otherwise(place)
    return place


def _around(words: Column, place: Column, fp: Column, length: int, reach: int) -> Column:
    """A gram with its fingerprint and the words that a window may reach to both sides, nearest first."""
    low = F.greatest(place - reach, F.lit(0))
    return F.struct(place.alias("start"), F.lit(length).alias("len"), fp.alias("fp"), _gram(words, place, length).alias("gram"),
                    F.reverse(F.slice(words, low + 1, place - low)).alias("left"),
                    F.slice(words, place + length + 1, F.lit(reach)).alias("right"))


def _fingerprints(words: Column, hashes: Column, minima: Column, window: int, k: int, listed=None) -> Column:
    """The distinct chosen grams of a text (of those whose hash is ``listed``), with the words around them."""
    grams = window - k + 1
    places = F.transform(minima, lambda fp, i: _chosen(hashes, fp, i, grams) if listed is None
                         else F.when(listed(fp), _chosen(hashes, fp, i, grams)))
    return F.transform(F.array_distinct(F.filter(places, lambda x: x.isNotNull())),
                       lambda x: _around(words, x, F.get(hashes, x), k, window - k))


def _slot(fp: Column, slots: int) -> Column:
    return F.shiftrightunsigned(fp, 6).bitwiseAND(F.lit(slots - 1)).cast("int")


def _mask(fp: Column) -> Column:
    # shiftleft of the constant 1 by the low six bits
    return F.call_function("shiftleft", F.lit(1).cast("long"), fp.bitwiseAND(F.lit(63)).cast("int"))


def benchmark_fingerprints(benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """One row for each distinct chosen gram of the items and the words around it: len, fp, gram, left,
    right, sorted item ids. Items of fewer than ``window`` words are one gram."""
    items = (benchmark.select(F.col("item_id"), alnum_words(ascii_lower(whole(F.col("text")))).alias("w"))
             .where(F.size("w") > 0))
    w = F.col("w")
    items = items.withColumn("h", _gram_hashes(w, k))
    items = items.withColumn("m", _winnow(F.col("h"), window - k + 1))
    long = (items.where(F.size("w") >= window)
            .select("item_id", F.explode(_fingerprints(w, F.col("h"), F.col("m"), window, k)).alias("x"))
            .select("item_id", "x.*"))
    none = F.array().cast("array<string>")
    short = (items.where(F.size("w") < window).select("item_id", F.concat_ws(" ", w).alias("gram"), F.size("w").alias("len"))
             .select("item_id", "len", F.xxhash64("gram").alias("fp"), "gram", none.alias("left"), none.alias("right")))
    return (long.drop("start").unionByName(short).groupBy("len", "fp", "gram", "left", "right")
            .agg(F.array_sort(F.collect_set("item_id")).alias("items")))


def fingerprint_bitmap(known: DataFrame, slots: int) -> DataFrame:
    """One row: an array of ``slots`` longs in which the fingerprints are set."""
    spark = known.sparkSession
    set_ = known.groupBy(_slot(F.col("fp"), slots).alias("slot")).agg(F.bit_or(_mask(F.col("fp"))).alias("bits"))
    return (spark.range(0, slots, 1, 1).select(F.col("id").cast("int").alias("slot"))
            .join(set_, "slot", "left")
            .groupBy().agg(F.sort_array(F.collect_list(F.struct("slot", F.coalesce("bits", F.lit(0)).alias("bits"))))
                           .alias("s"))
            .select(F.transform("s", lambda x: x["bits"]).alias("bitmap")))


def _alike(a: Column, b: Column) -> Column:
    """Number of leading words that two lists share."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    apart = F.array_position(same, False)
    return F.when(apart > 0, (apart - 1).cast("int")).otherwise(F.size(same))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per document row: id, ``row_key``, n_words, ``hit_spans`` (word ranges, end
    exclusive), n_hit and items (sorted ids of the items that have a window in it)."""
    known = stored(benchmark_fingerprints(benchmark, window, k), "decontam-known")
    # Two small facts of the test set, taken first: how many fingerprints, and which short lengths.
    short_len = F.collect_set(F.when((F.col("len") != k) | (F.size("left") + F.size("right") == 0), F.col("len")))
    facts = known.agg(F.count_distinct("fp").alias("n"), short_len.alias("short")).first()
    short = sorted(n for n in facts["short"] if n < window)
    slots = min(SLOTS_MOST, max(SLOTS_LEAST, 1 << (max(1, facts["n"]) // 4).bit_length()))
    w, h = F.col("w"), F.col("h")
    d = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row_key"),
                    ascii_lower(whole(F.col(text_col))).alias("t"))
    d = d.select("id", "row_key", alnum_words(F.col("t")).alias("w"))
    d = d.withColumn("h", _gram_hashes(w, k))
    d = d.withColumn("m", _winnow(h, window - k + 1))
    bitmap = fingerprint_bitmap(known, slots).scalar()
    # Each pass has a bitmap column of its own: used once, the optimizer puts the
    # subquery's value in place, and no row carries the array.
    d = d.withColumns({f"bitmap{n}": bitmap for n in [window, *short]})

    def listed(length: int):
        bits = F.col(f"bitmap{length}")
        return lambda fp: F.get(bits, _slot(fp, slots)).bitwiseAND(_mask(fp)) != 0

    def whole_items(length: int) -> Column:
        hashed = F.transform(starts(w, length), lambda i: F.xxhash64(_gram(w, i, length)))
        return F.filter(F.transform(hashed, lambda fp, i: F.when(listed(length)(fp), _around(w, i, fp, length, 0))),
                        lambda x: x.isNotNull())

    passes = [_fingerprints(w, h, F.col("m"), window, k, listed(window)), *[whole_items(n) for n in short]]
    found = passes[0] if len(passes) == 1 else F.concat(*passes)
    rows = stored(d.select(F.monotonically_increasing_id().alias("row"), "id", "row_key",
                           F.size("w").cast("long").alias("n_words"), found.alias("found")), "decontam-found")
    hits = rows.where(F.size("found") > 0).select("row", F.explode("found").alias("x")).select(
        "row", F.pmod("row", F.lit(SALTS)).cast("int").alias("salt"), "x.*")
    of = known.select("len", "fp", "gram", F.col("left").alias("item_left"), F.col("right").alias("item_right"), "items",
                      F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    extended = hits.join(of, ["len", "fp", "gram", "salt"]).select(
        "row", "start", "len", "items", (F.size("item_left") + F.size("item_right") == 0).alias("whole"), _alike(F.col("left"), F.col("item_left")).alias("l"),
        _alike(F.col("right"), F.col("item_right")).alias("r"))
    span = F.col("l") + F.col("len") + F.col("r")
    # A short item is a window by itself: it has no words around it.
    enough = (span >= window) | (F.col("whole") & (F.col("len") < window))
    per_row = extended.where(enough).groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct((F.col("start") - F.col("l")).alias("start"),
                                            (F.col("start") + F.col("len") + F.col("r")).alias("end")))).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    # Ranges are sorted by start: each adds the words beyond the end so far.
    n_hit = F.aggregate("ranges", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
                        lambda a, r: F.struct(
                            (a["n"] + F.greatest(F.lit(0), r["end"] - F.greatest(r["start"], a["end"]))).alias("n"),
                            F.greatest(a["end"], r["end"]).alias("end")), lambda a: a["n"])
    none = F.array().cast(known.schema["items"].dataType)
    return rows.drop("found").join(per_row.withColumn("n_hit", n_hit), "row", "left").select(
        F.col("id").alias(id_col), "row_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.col("ranges").alias("hit_spans"), F.coalesce("items", none).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      max_hit_percent: float = 0.0, **options) -> DataFrame:
    """``docs`` without the rows of which more than ``max_hit_percent`` of the words are hit."""
    flagged = (contamination(docs, benchmark, id_col, text_col, **options)
               .where((F.col("n_hit") > 0) & (F.col("n_hit") * 100 > F.col("n_words") * F.lit(max_hit_percent)))
               .select(F.col(id_col).alias("__id"), F.col("row_key").alias("__key")).distinct())
    same = (row_key(id_col, text_col) == F.col("__key")) & F.col(id_col).eqNullSafe(F.col("__id"))
    return docs.join(flagged, same, "left_anti")


def decontam_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of ``op10``: one row per document."""
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return contamination(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))

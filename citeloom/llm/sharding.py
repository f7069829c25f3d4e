"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of slots (thousands); a map, kept as a
versioned table, says which shard holds each slot. Version 1 deals the slots
out evenly; bytes are summed by slot, and the map is edited, as version 2, to
balance the shards' bytes. Later edits follow other sizes or numbers of shards:
records never change their slot, and an edit moves as few slots as it can.

Records are written once with their slot (below ``spark.checkpoint.dir``), so
the bytes that the map is made from and the records that it deals out are the
same rows even if a task runs twice. The map has one row a slot, whatever the
size of the corpus; planning it on the driver and broadcasting it are bounded
by the number of slots. Records are shuffled once, by slot, to number them
within their shard.

Defined results: a null text has one byte (its end); a record's slot is hashed from its id
and text; records without id have nothing that tells them apart and are dealt to slots by
their place in the written table, so that equal ones do not meet in one; repeated rows with
an id share their slot; an empty table gives an empty result and a map of empty slots; columns
of the input pass through, those named like an added one are replaced.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch_path, stored, whole

SLOTS = 4096
SHARDS = 8
#: Columns that the records get.
ADDED = ("size", "vslot", "shard", "slot")
ORDER = "__shard_order"
MAP = "version int, vslot int, shard int, bytes long, rows long, first long"


def record_size(text: Column) -> Column:
    return (F.octet_length(whole(text)) + 1).cast("long")


def virtual_slot(id_col: str, text_col: str, slots: int = SLOTS) -> Column:
    known = F.xxhash64(F.col(id_col), F.col(text_col))
    own = F.xxhash64(F.col(text_col), F.monotonically_increasing_id())
    return F.pmod(F.when(F.col(id_col).isNull(), own).otherwise(known), F.lit(slots)).cast("int")


def slotted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS,
            without: Sequence[str] = ()) -> DataFrame:
    """``docs`` with size, vslot and what orders a slot's records, as a written table; the columns
    ``without`` stay behind."""
    kept = docs.drop(*[c for c in (*ADDED, ORDER) if c not in (id_col, text_col)])
    return stored(kept.withColumns({
        "size": record_size(F.col(text_col)), "vslot": virtual_slot(id_col, text_col, slots),
        ORDER: F.xxhash64(F.col(text_col), F.col(id_col))}).drop(*without), "slotted")


def slot_bytes(records: DataFrame, slots: int = SLOTS) -> list[tuple]:
    """(vslot, bytes, rows) of every slot of ``slotted`` records, empty ones too: ``slots`` rows."""
    got = {r["vslot"]: (r["bytes"], r["rows"]) for r in
           records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()}
    return [(v, *got.get(v, (0, 0))) for v in range(slots)]


def even_map(shards: int = SHARDS, slots: int = SLOTS) -> dict[int, int]:
    """Slot to shard before any record is known: as many slots to each."""
    return {v: v % shards for v in range(slots)}


def plan_map(sizes: list[tuple], shards: int = SHARDS) -> dict[int, int]:
    """Slot to shard: largest slots first, each to the shard with the fewest bytes."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for vslot, size, _ in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        out[vslot] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def rebalance(sizes: list[tuple], current: dict[int, int], shards: int) -> dict[int, int]:
    """``current`` edited for ``shards`` shards: slots leave the fullest shard for the emptiest
    while that narrows the gap between the two; slots of shards that are gone move first."""
    size = {v: b for v, b, _ in sizes}
    out = dict(current)
    held: list[dict[int, int]] = [{} for _ in range(shards)]
    homeless = []
    for v, s in sorted(out.items()):
        if s < shards:
            held[s][v] = size[v]
        else:
            homeless.append(v)
    load = [sum(h.values()) for h in held]
    for v in sorted(homeless, key=lambda v: (-size[v], v)):
        s = load.index(min(load))
        held[s][v], out[v] = size[v], s
        load[s] += size[v]
    while True:
        high, low = load.index(max(load)), load.index(min(load))
        gap = load[high] - load[low]
        fits = [(b, -v) for v, b in held[high].items() if 0 < b < gap]
        if not fits:
            return out
        # The slot that comes nearest to half the gap.
        b, v = min(fits, key=lambda x: (abs(2 * x[0] - gap), x))
        held[low][-v] = held[high].pop(-v)
        out[-v] = low
        load[high] -= b
        load[low] += b


def map_table(spark: SparkSession, sizes: list[tuple], shard_of: dict[int, int], version: int) -> DataFrame:
    """The map as rows; ``first`` is the place of a slot's first record in its shard."""
    rows, places = [], {}
    for vslot, size, n in sizes:
        shard = shard_of[vslot]
        rows.append((version, vslot, shard, size, n, places.get(shard, 0)))
        places[shard] = places.get(shard, 0) + n
    return spark.createDataFrame(rows, MAP)


def save_map(table: DataFrame, path: str) -> None:
    """Adds a version to the stored map. A version that is there is refused, never written again."""
    spark = table.sparkSession
    versions = {r["version"] for r in table.select("version").distinct().collect()}
    try:
        there = {r["version"] for r in spark.read.schema(MAP).parquet(path).select("version").distinct().collect()}
    except AnalysisException as none:
        if "PATH_NOT_FOUND" not in (none.getCondition() or ""):
            raise
        there = set()
    if versions & there:
        raise ValueError(f"{path} has version {sorted(versions & there)} of the map already")
    table.write.partitionBy("version").mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the stored map, the last by default."""
    table = spark.read.schema(MAP).parquet(path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.where(F.col("version") == version)


def assign(records: DataFrame, shard_map: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``slotted`` records with shard and slot, the record's place in its shard (gapless from 0).

    Raises where the map lacks the slot of a record.
    """
    at = F.col("__map")
    place = F.row_number().over(Window.partitionBy("vslot").orderBy(ORDER, F.col(id_col))) - 1
    d = records.withColumn("__place", place)
    # `slots` rows: the map's size is fixed by a parameter.
    where = F.broadcast(shard_map.select(F.col("vslot").alias("__vslot"), F.struct("shard", "first").alias("__map")))
    known = F.coalesce(at, F.raise_error(F.concat(F.lit("the map has no slot "), F.col("vslot").cast("string"))).cast(
        "struct<shard:int,first:bigint>"))
    d = d.join(where, F.col("vslot") == F.col("__vslot"), "left").withColumn("__map", known)
    return d.withColumns({"shard": at["shard"], "slot": at["first"] + F.col("__place")}).drop(
        ORDER, "__place", "__vslot", "__map")


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, path: str | None = None,
          id_col: str = "doc_id", text_col: str = "text", without: Sequence[str] = ()) -> DataFrame:
    """Stores the even map as version 1 at ``path`` (a new folder in the shared one by default), edits
    it by the bytes of ``docs``, stores that as version 2 and assigns the records by it."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "llm-slot-map")
    records = slotted(docs, id_col, text_col, slots, without)
    sizes = slot_bytes(records, slots)
    first = even_map(shards, slots)
    save_map(map_table(spark, sizes, first, 1), path)
    save_map(map_table(spark, sizes, rebalance(sizes, first, shards), 2), path)
    return assign(records, load_map(spark, path), id_col)


def sharding_digest(docs: DataFrame) -> DataFrame:
    """The digest of ``op3``: one row per document; sizes of the shards are nearly equal."""
    # Texts stay behind: what is written and shuffled has their checksum and size.
    summed = docs.select("doc_id", "text", F.crc32(whole(F.col("text")).cast("binary")).alias("text_crc32"))
    return shard(summed, without=["text"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "vslot")

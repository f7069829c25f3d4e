"""Mixing sources to target weights (DataFrame functions only).

1. Sizes are summed for each source in 65,536 hash cells; running sums over a
   source's cells give every document its place in the source's stream, which
   is in hash order, i.e. a fixed random permutation of its documents. Cells
   split hot sources: no window holds more than one cell of one source.
2. Targets: the shares of all sizes by weight; a target stops at
   ``max_epochs`` times its source's size and the excess is shared anew by
   weight (solved in closed form by one running sum over the sources).
3. A source's stream, repeated up to ``max_epochs`` times, is drawn up to its
   target. A document is drawn as often as its middle word lies before the
   target, so the words taken are within half a document of it.
4. Blocks of equal size in words cut the drawn streams, which gives each source
   an exact quota of blocks. A binary tree deals the quotas to the output
   shards: each node draws, by selection sampling, how many blocks of each
   source go left, a multivariate hypergeometric sample; every leaf has an
   exact quota of each source, and quotas add up at every level.
5. A shard takes its quota of each source as the next disjoint run of blocks of
   the permuted stream, and orders its documents by hash.

The targets work on one row a source, the tree on one row a block: at most
``blocks`` and one a source, whatever the size of the corpus. Their windows
hold those rows only, so they are bounded by the number of sources.

Defined results: a null text has size 0; documents of size 0 are never drawn;
null sources are one source, ranked last; null ids pass through; repeated rows
are separate documents with places of their own; an empty table gives an empty
result; columns of the input pass through unless they begin with ``__mix_``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blank_words, whole

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
CELL_BITS = 16
BLOCKS = 1 << 16
SHARDS = 16
SEED = 17


def word_count(text: Column) -> Column:
    return F.size(blank_words(whole(text))).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size; one row a source) with rank, weight, total and target."""
    # One row a source: the windows below hold a mix's sources, not its documents.
    everything = Window.partitionBy()
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumns({"weight": weight, "cap": F.col("source_size") * max_epochs,
                                 "total": F.sum("source_size").over(everything)})
    # In the order in which sources reach their caps, level k is the share of a unit of weight
    # once the first k sources stand at theirs. The first source that its level leaves below
    # its cap fixes the level of all that follow.
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumns({
        "level": (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))),
        "place": F.row_number().over(order)})
    fixed = F.min_by(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("level")),
                     F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("place"))).over(everything)
    return ranked.select("source", "source_size", "rank", "weight", "total", F.least(
        F.col("cap").cast("double"), F.coalesce(fixed * F.col("weight"), F.col("cap").cast("double"))).alias("target"))


def _split(tree: DataFrame, seed: int) -> DataFrame:
    """The children of the tree's nodes: ``tree`` has a row a block (rank, block) with its node, the
    ``n`` shards from ``low`` on. A node of one shard stays."""
    node = Window.partitionBy("low", "n")
    drawn = F.row_number().over(node.orderBy(F.xxhash64(F.lit(seed), "low", "n", "rank", "block"), "rank", "block"))
    half = F.floor(F.col("n") / 2).cast("int")
    left = drawn <= F.floor(F.count("*").over(node) * half / F.col("n"))
    return tree.withColumns({"half": half, "left": left}).select(
        "rank", "block",
        F.when((F.col("n") > 1) & ~F.col("left"), F.col("low") + F.col("half")).otherwise(F.col("low")).alias("low"),
        F.when(F.col("n") <= 1, F.col("n")).when(F.col("left"), F.col("half"))
        .otherwise(F.col("n") - F.col("half")).alias("n"))


def shard_quotas(sources: DataFrame, shards: int = SHARDS, blocks: int = BLOCKS, seed: int = SEED) -> DataFrame:
    """``sources`` with ``block_words`` and ``firsts``: for each shard the first of its source's
    blocks that it takes (its quota is the distance to the next).

    The tree's nodes are rows, one a block: a node orders its blocks by a hash of its own and sends
    the first of them left, as many as its left shards' part. Blocks drawn without replacement
    have hypergeometric counts by source.
    """
    sources = sources.withColumn("block_words", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("total") / blocks)))
    sources = sources.withColumn("quota", F.ceil(F.col("target") / F.col("block_words")).cast("long"))
    tree = (sources.where(F.col("quota") > 0)
            .select("rank", F.explode(F.sequence(F.lit(1).cast("long"), "quota")).alias("block"))
            .withColumns({"low": F.lit(0), "n": F.lit(shards)}))
    for _ in range(math.ceil(math.log2(max(1, shards)))):
        tree = _split(tree, seed)
    quotas = tree.groupBy("rank").pivot("low", list(range(shards))).count()
    firsts = quotas.select(F.col("rank").alias("at"), F.array(*[
        sum((F.coalesce(f"`{s}`", F.lit(0).cast("long")) for s in range(shard)), F.lit(0).cast("long"))
        for shard in range(shards)]).alias("firsts"))
    return sources.join(firsts, F.col("rank") == F.col("at"), "left").drop("at")


def _running(cells: DataFrame) -> DataFrame:
    """The words before each cell of its source's stream, by two levels of sums: no window holds more
    than the square root of a source's cells."""
    earlier = lambda w: F.coalesce(F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.withColumn("__mix_band", F.shiftright("__mix_cell", CELL_BITS // 2))
    bands = cells.groupBy("__mix_key", "__mix_band").agg(F.sum("words").alias("words"))
    bands = bands.select("__mix_key", "__mix_band", earlier(
        Window.partitionBy("__mix_key").orderBy("__mix_band")).alias("__mix_bands"))
    inside = earlier(Window.partitionBy("__mix_key", "__mix_band").orderBy("__mix_cell"))
    return cells.withColumn("__mix_inside", inside).join(bands, ["__mix_key", "__mix_band"]).select(
        "__mix_key", "__mix_cell", (F.col("__mix_bands") + F.col("__mix_inside")).alias("__mix_earlier"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        shards: int = SHARDS, blocks: int = BLOCKS, max_epochs: int = MAX_EPOCHS,
        weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """``docs`` with the struct column ``__mix_``: size, source_size, target and draws.

    ``draws`` has an element (copy, block, shard, place) for each time the
    document is drawn; ``place`` orders the documents of a shard.
    """
    d = docs.withColumns({
        "__mix_size": word_count(F.col(text_col)),
        "__mix_hash": F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)),
        # A key that is never null; it keeps the order of the sources.
        "__mix_key": F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("")),
    }).withColumn("__mix_cell", F.shiftright("__mix_hash", 64 - CELL_BITS))
    cells = d.groupBy("__mix_key", "__mix_cell").agg(F.sum("__mix_size").alias("words"))
    sizes = (cells.groupBy("__mix_key").agg(F.sum("words").alias("source_size"))
             .withColumn("source", F.when(F.col("__mix_key") != "", F.col("__mix_key"))))
    plan = shard_quotas(targets(sizes.select("source", "source_size"), weights, max_epochs), shards, blocks, seed)
    plan = plan.select(F.coalesce("source", F.lit("")).alias("__mix_key"), F.struct(
        "source_size", "target", "block_words", "firsts").alias("__mix_plan"))
    cells = _running(cells).join(plan, "__mix_key")
    inside = (Window.partitionBy("__mix_key", "__mix_cell").orderBy("__mix_hash", "__mix_size")
              .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("__mix_before", F.coalesce(F.sum("__mix_size").over(inside), F.lit(0)))
    d = d.join(cells, ["__mix_key", "__mix_cell"])
    middle = F.col("__mix_earlier") + F.col("__mix_before") + F.floor(F.col("__mix_size") / 2)
    of = {c: F.col("__mix_plan")[c] for c in ("source_size", "target", "block_words", "firsts")}

    def draw(copy: Column) -> Column:
        place = copy * of["source_size"] + middle
        block = F.floor(place / of["block_words"])
        return F.when((F.col("__mix_size") > 0) & (place < of["target"]), F.struct(
            copy.alias("copy"), block.alias("block"),
            (F.size(F.filter(of["firsts"], lambda x: x <= block)) - 1).alias("shard"),
            F.xxhash64(F.lit(seed), "__mix_hash", copy).alias("place")))

    draws = F.filter(F.array(*[draw(F.lit(k)) for k in range(max_epochs)]), lambda x: x.isNotNull())
    return d.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(
        F.col("__mix_size").alias("size"), of["source_size"].alias("source_size"), of["target"].alias("target"),
        draws.alias("draws")).alias("__mix_"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as mixed: every document as often as it is drawn, columns as before."""
    return (mix(docs, **options).withColumn("__mix_draw", F.explode("__mix_.draws"))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Writes the mix, one folder a shard, documents in their shuffled order within each file."""
    d = mix(docs, **options).withColumn("__mix_draw", F.explode("__mix_.draws"))
    (d.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("__mix_draw.shard").alias("shard"),
              F.col("__mix_draw.place").alias("__mix_place"))
     .repartition("shard", F.shiftright("__mix_place", 60))  # 16 files a shard
     .sortWithinPartitions("shard", "__mix_place").drop("__mix_place")
     .write.partitionBy("shard").parquet(path))


def mixing_digest(docs: DataFrame) -> DataFrame:
    """The digest of ``op2``: one row per document."""
    m = F.col("__mix_")
    return mix(docs.select("doc_id", "text", "source")).select(
        "doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"),
        (m["size"] * F.size(m["draws"])).alias("taken"),
        F.concat_ws(",", F.transform(m["draws"], lambda x: x["shard"].cast("string"))).alias("shards"))

"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: the mix holds `share` of all words. Sources share it by weight; none gets more than
`most` times its own words, and what that leaves over goes to the others by weight.

Schedule: slot i has the golden-ratio point frac(i * 0.618...), in 32-bit integers, so reruns and
other engines agree to the bit. The point falls into one source's part of the cumulated targets.
The r-th slot of a source takes block r of it, so any stretch of slots holds the sources in
nearly the target shares. By these slots alone a source ends within a few blocks of its target, and one of a
block or two may get none; with `exact`, slots after the target are dropped, those missing come after all
others, the last block is cut, and every source ends at its target, rounded down to words.

Blocks: a source's documents, shuffled by a hash of their ids, are laid end to end, `most` times
over, and cut into blocks of equal words. A document is never taken more often than `most` times.

Nothing is gathered by source: slots are ranked in chunks and documents placed in hash buckets,
each with a running sum of small counts before it, and slots meet documents on (source, block).
The table of sources is sorted in one task; it has one row a source.

A null source is a source of its own, after all others. Null and empty texts have size zero: they
are returned, with nothing taken. Rows with equal or null ids are separate rows, ordered by size.
An empty table gives an empty mix. Input columns with other names are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.line_dedup import two_hashes
from tidemark.llm.text import count_words, set_aside, words
from tidemark.session import settle

GOLDEN, CIRCLE = 2654435769, 1 << 32
CELL = 1 << 20
CHUNK = 4096


@dataclass(frozen=True)
class Mix:
    """`sources`: no, source, source_size, weight, target. `rows`: one per document, placed in its
    source. `slots`: slot, no, rank (the block of that source), upto (the word of the source it ends before). `block`: words in a block."""

    sources: DataFrame
    rows: DataFrame
    slots: DataFrame
    block: int
    most: int


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """Sources by code point, null last, with repeating weights and capped targets, from rows of source and size."""
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("no", F.row_number().over(by_source))
    weight = F.get(F.array(*(F.lit(w) for w in weights)), F.pmod(F.col("no") - 1, F.lit(len(weights))))
    sources = sources.withColumn("weight", weight.cast("long")).withColumn("cap", most * F.col("source_size"))
    # Sources that reach their cap at the lowest level come first; the level of the rest is what is left over their weights.
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "no")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    leveled = sources.withColumn("place", F.row_number().over(by_level)).withColumn("level", left / open_weight)
    first = F.min(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.struct("place", "level"))).over(everything)
    leveled = leveled.withColumn("first", first)
    target = F.when(F.col("place") >= F.col("first.place"), F.col("weight") * F.col("first.level")).otherwise(F.col("cap").cast("double"))
    return leveled.select("no", "source", "source_size", "weight", target.alias("target"))


def place(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Every document's place in its source's shuffled order: bucket, nth, and `start`, the words before it."""
    shuffled = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    keyed = sizes.join(sources.select("no", F.col("source").alias("__source"), "source_size"), F.col("source").eqNullSafe(F.col("__source")))
    keyed = keyed.drop("__source", "source").withColumn("h", shuffled).withColumn("bucket", F.substring("h", 1, 4))
    along = Window.partitionBy("no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = keyed.groupBy("no", "bucket").agg(F.sum("size").alias("n")).select("no", "bucket", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("no", "bucket").orderBy("h", "doc_id", "size", "row_key")
    placed = keyed.withColumn("nth", F.row_number().over(inside)).withColumn("within", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    return placed.join(buckets, ["no", "bucket"]).select("no", "bucket", "nth", "doc_id", "row_key", "size", "source_size", (F.col("ahead") + F.col("within")).alias("start"))


def schedule(sources: DataFrame, n_slots: int) -> DataFrame:
    """slot, no, rank: which source a slot belongs to, and how many of its slots came before."""
    along = Window.orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    part = F.floor(F.col("target")).cast("long")
    cut = sources.withColumn("upto", F.sum(part).over(along)).withColumn("all", F.sum(part).over(Window.partitionBy()))
    scaled = lambda words: F.floor(words.cast("double") / F.col("all").cast("double") * float(CIRCLE)).cast("long")
    cut = cut.where(part > 0).select("no", scaled(F.col("upto") - part).alias("low"), scaled(F.col("upto")).alias("high")).where("high > low")
    cells = F.explode(F.sequence(F.floor(F.col("low") / CELL), F.floor((F.col("high") - 1) / CELL))).alias("cell")
    cut = cut.select("no", "low", "high", cells)
    half = lambda shift: F.shiftright("id", shift).bitwiseAND(F.lit(0xFFFF))
    point = F.pmod(F.pmod(half(16) * F.lit(GOLDEN), F.lit(CIRCLE)) * 0x10000 + half(0) * F.lit(GOLDEN), F.lit(CIRCLE))  # slot * GOLDEN, which a long cannot hold
    slots = cut.sparkSession.range(n_slots).select(F.col("id").alias("slot"), point.alias("u"))
    slots = slots.withColumn("cell", F.floor(F.col("u") / CELL)).join(cut, "cell").where("u >= low AND u < high")
    slots = slots.select("slot", "no", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    along = Window.partitionBy("no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = slots.groupBy("no", "chunk").count().select("no", "chunk", F.coalesce(F.sum("count").over(along), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("no", "chunk").orderBy("slot")
    return slots.withColumn("nth", F.row_number().over(inside)).join(chunks, ["no", "chunk"]).select("slot", "no", (F.col("ahead") + F.col("nth") - 1).alias("rank"))


def to_target(slots: DataFrame, sources: DataFrame, block: int, n_slots: int) -> DataFrame:
    """The slots with as many ranks of every source as its target has blocks; `upto` ends the last one at the target."""
    part = F.floor(F.col("target")).cast("long")
    had = slots.groupBy("no").count()
    needs = sources.join(had, "no", "left").select("no", part.alias("part"), F.coalesce("count", F.lit(0)).alias("had"), F.ceil(part / block).alias("needs"))
    kept = slots.join(needs, "no").where(F.col("rank") < F.col("needs")).select("slot", "no", "rank", "part")
    along = Window.orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    short = needs.where("had < needs").withColumn("ahead", F.coalesce(F.sum(F.col("needs") - F.col("had")).over(along), F.lit(0)))
    more = short.select("*", F.explode(F.sequence("had", F.col("needs") - 1)).alias("rank"))
    more = more.select((n_slots + F.col("ahead") + F.col("rank") - F.col("had")).alias("slot"), "no", "rank", "part")
    return kept.unionByName(more).select("slot", "no", "rank", F.least("part", (F.col("rank") + 1) * block).alias("upto"))


def plan(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, block_words: int = 1024, least_blocks: int = 1 << 16, exact: bool = False, row_key: Column | None = None) -> Mix:
    """The mix of a table of doc_id, text and source.

    A block holds `block_words`, or fewer if the mix would then have under `least_blocks` blocks. `row_key` tells
    rows of equal ids apart; without one, a hash of all columns orders them.
    """
    sizes = settle(docs.select(F.col("doc_id"), F.col("source"), count_words(F.col("text")).alias("size"), (F.xxhash64(*docs.columns) if row_key is None else row_key).alias("row_key")))
    sources = settle(targets(sizes, weights, share, most))
    mixed = int(sources.agg(F.sum(F.floor("target"))).first()[0] or 0)
    block = min(block_words, max(1, mixed // least_blocks))
    n_slots = -(-mixed // block)
    slots = schedule(sources, n_slots)
    slots = to_target(settle(slots), sources, block, n_slots) if exact else slots.withColumn("upto", (F.col("rank") + 1) * block)
    return Mix(sources, place(sizes, sources), slots, block, most)


def pieces(mix: Mix) -> DataFrame:
    """Documents met with slots: per document, copy and slot the words [from, upto) taken; one row with null slot where nothing is."""
    copies = F.explode(F.sequence(F.lit(0), F.lit(mix.most - 1))).alias("copy")
    rows = mix.rows.select("*", copies).withColumn("at", F.col("start") + F.col("copy") * F.col("source_size"))
    last = F.floor((F.col("at") + F.col("size") - 1) / mix.block)
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("at") / mix.block), last))
    rows = rows.select("*", F.explode_outer(blocks).alias("rank"))
    met = rows.join(mix.slots.withColumnRenamed("upto", "end"), ["no", "rank"], "left")
    low = F.greatest(F.col("at"), F.col("rank") * mix.block) - F.col("at")
    high = F.least(F.col("at") + F.col("size"), F.col("end")) - F.col("at")
    taken = F.col("slot").isNotNull() & (high > low)  # a last block may end before the document
    return met.select("no", "bucket", "nth", "doc_id", "row_key", "size", "source_size", "copy", F.when(taken, F.col("slot")).alias("slot"), F.when(taken, low).alias("from"), F.when(taken, high).alias("upto"))


def taken_words(mix: Mix) -> DataFrame:
    """doc_id, size, source_size, target and `taken` (words the mix takes, repeats counted) of every document."""
    each = pieces(mix).groupBy("no", "bucket", "nth").agg(
        F.first("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("source_size").alias("source_size"),
        F.coalesce(F.sum(F.col("upto") - F.col("from")), F.lit(0)).cast("long").alias("taken"),
    )
    return each.join(mix.sources.select("no", "target"), "no").select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, all columns kept, once for each copy taken; a copy cut by the end of the mix keeps only the words taken."""
    docs, back = set_aside(docs, {"__key", "__from", "__upto", "__size"})
    row = F.struct(*two_hashes(*(F.col(f"`{c}`") for c in docs.columns)))  # 128 bits
    mix = plan(docs, row_key=row, **options)
    # Each step is a plan of its own: the driver's memory follows the largest plan. No text is written with them.
    mix = replace(mix, rows=settle(mix.rows), slots=settle(mix.slots))
    spans = pieces(mix).where("slot IS NOT NULL").groupBy("row_key", "no", "bucket", "nth", "copy").agg(F.min("from").alias("__from"), F.max("upto").alias("__upto"), F.first("size").alias("__size"))
    spans = settle(spans.select(F.col("row_key").alias("__key"), "__from", "__upto", "__size"))
    texts = docs.withColumn("__key", row).dropDuplicates(["__key"])
    whole = (F.col("__from") == 0) & (F.col("__upto") == F.col("__size"))
    cut = F.array_join(F.slice(words(F.col("text")), (F.col("__from") + 1).cast("int"), (F.col("__upto") - F.col("__from")).cast("int")), " ")
    return texts.join(spans, "__key").withColumn("text", F.when(whole, F.col("text")).otherwise(cut)).select(*back)

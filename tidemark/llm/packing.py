"""Conflict-constrained best-fit packing of documents into bins of equal length.

A document longer than a bin is cut into full pieces and a rest. Pieces are dealt to shards by a
hash, some thousands to a shard, and each shard is packed on its own, largest pieces first. Bins are
kept in the order of what is left in them, and each carries a bitmap of its sources and one of its
duplicate clusters. A piece goes into the bin with the least room that still holds it; if that bin
has a conflict, the search goes on to its successors until the tightest compatible bin is found, and
a new bin is opened only if there is none. Rooms whose bins are all closed to the piece's source are passed over by a bitmap of the source.

Conflicts: a bin holds at most one piece of a duplicate cluster and `per_source` pieces of a source.
Clusters are a column, or else documents with the same lower-cased words.

A row's shard follows a number of its own besides its id and cluster, so a source, a group of copies, repeated
rows or rows without an id are spread over all of them, whatever their part of the rows. The number of shards
follows the words and pieces, their size does not. The numbers are those of one run: another order of rows gives other bins.

Null sources are one source, a null in the cluster column is a cluster of one. Null ids and repeated rows are packed like
all others; repeated rows are copies. Documents without words are returned with no bin. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import words
from tidemark.session import settle

SCHEMA = "doc_id long, piece long, first_word long, n_words long, bin long, bin_offset long"


class Bins:
    """Open bins by what is left in them."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.by_room: dict[int, list[int]] = {}
        self.rooms = 0  # bit r is set if a bin has r words left
        self.left: list[int] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.full: list[list[int]] = []  # sources a bin holds all it may of
        self.closed: dict[int, dict[int, int]] = {}  # by room and source, the bins closed to the source
        self.shut: dict[int, int] = {}  # by source, the rooms all of whose bins are closed to it

    def put(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Place a piece; `cluster` is a bit, or zero for a cluster of one. Returns the bin and the offset in it."""
        full = 1 << (source * self.per_source + self.per_source - 1)
        room, later = size, (self.rooms & ~self.shut.get(source, 0)) >> size
        while later:
            skip = (later & -later).bit_length() - 1
            room, later = room + skip, later >> skip
            for at, number in enumerate(self.by_room[room]):
                if not (self.sources[number] & full or self.clusters[number] & cluster):
                    self._leave(room, at)
                    return number, self._add(number, size, source, cluster)
            room, later = room + 1, later >> 1
        self.left.append(self.capacity)
        self.sources.append(0)
        self.clusters.append(0)
        self.full.append([])
        return len(self.left) - 1, self._add(len(self.left) - 1, size, source, cluster)

    def _add(self, number: int, size: int, source: int, cluster: int) -> int:
        low = source * self.per_source
        held = (self.sources[number] >> low) & ((1 << self.per_source) - 1)
        self.sources[number] |= ((held << 1) | 1) << low  # one more of the source's bits, lowest first
        self.clusters[number] |= cluster
        offset = self.capacity - self.left[number]
        self.left[number] -= size
        if held + 1 == 1 << (self.per_source - 1):
            self.full[number].append(source)
        if self.left[number]:
            self._enter(self.left[number], number)
        return offset

    def _enter(self, room: int, number: int) -> None:
        self.by_room.setdefault(room, []).append(number)
        self.rooms |= 1 << room
        closed = self.closed.setdefault(room, {})
        for source in self.full[number]:
            closed[source] = closed.get(source, 0) + 1
        self._compare(room)

    def _leave(self, room: int, at: int) -> None:
        closed = self.closed[room]
        for source in self.full[self.by_room[room].pop(at)]:
            closed[source] -= 1
        if not self.by_room[room]:
            self.rooms &= ~(1 << room)
        self._compare(room)

    def _compare(self, room: int) -> None:
        """Mark the sources to which every bin of a room is closed."""
        bins, closed = len(self.by_room[room]), self.closed[room]
        for source, n in list(closed.items()):
            if n and n == bins:
                self.shut[source] = self.shut.get(source, 0) | 1 << room
            else:
                self.shut[source] = self.shut.get(source, 0) & ~(1 << room)
                if not n:
                    del closed[source]


def pack_shard(pieces: pd.DataFrame, capacity: int, per_source: int) -> pd.DataFrame:
    """Bin numbers (from 0) and offsets for the pieces of one shard: doc_id, piece, first_word, n_words, source, cluster."""
    pieces = pieces.sort_values(["n_words", "cluster", "doc_id", "piece"], ascending=[False, True, True, True], kind="stable")
    source_of = {name: i for i, name in enumerate(sorted(set(pieces["source"])))}
    common = sorted(cluster for cluster, n in Counter(pieces["cluster"]).items() if n > 1)
    bit_of = {cluster: 1 << i for i, cluster in enumerate(common)}
    bins = Bins(capacity, per_source)
    placed = [bins.put(size, source_of[source], bit_of.get(cluster, 0)) for size, source, cluster in zip(pieces["n_words"].tolist(), pieces["source"], pieces["cluster"], strict=True)]
    return pieces.assign(bin=[p[0] for p in placed], bin_offset=[p[1] for p in placed])


def pack(docs: DataFrame, capacity: int = 2048, per_source: int = 2, cluster: Column | None = None, shard_words: int = 1 << 22, shard_pieces: int = 8192) -> DataFrame:
    """doc_id, piece, first_word, n_words, bin, bin_offset of every piece of every document of doc_id, source and text."""
    found = words(F.lower("text"))
    number = F.monotonically_increasing_id()
    source = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source").cast("string")))
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), F.size(found).cast("long").alias("size"), (found if cluster is None else cluster).alias("group"), number.alias("number"))
    alone = F.xxhash64(F.lit("alone"), F.col("number"))
    group = F.xxhash64("group") if cluster is None else F.when(F.col("group").isNull(), alone).otherwise(F.xxhash64("group"))
    sizes = settle(sizes.select("doc_id", "source", "size", group.alias("cluster"), F.xxhash64("doc_id", group, "number").alias("row_key")))
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / capacity))).alias("piece")
    cut = sizes.where("size > 0").select("doc_id", "source", "size", "cluster", "row_key", pieces)
    first = F.col("piece") * capacity
    cut = cut.select("doc_id", "source", "cluster", "row_key", "piece", first.alias("first_word"), F.least(F.lit(capacity).cast("long"), F.col("size") - first).alias("n_words"))
    total, n = sizes.where("size > 0").agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum(F.ceil(F.col("size") / capacity)), F.lit(0))).first()
    shards = max(1, -(-total // shard_words), -(-n // shard_pieces))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = pack_shard(rows, capacity, per_source)
        out["bin"] += int(key[0]) << 24
        return out[["doc_id", "piece", "first_word", "n_words", "bin", "bin_offset"]]

    shard = F.pmod(F.xxhash64("row_key", "piece"), F.lit(shards))
    packed = cut.withColumn("shard", shard).drop("row_key").groupBy("shard").applyInPandas(run, SCHEMA)
    nothing = F.lit(None).cast("long")
    empty = sizes.where("size = 0").select("doc_id", *(F.lit(0).cast("long").alias(c) for c in ("piece", "first_word", "n_words")), nothing.alias("bin"), nothing.alias("bin_offset"))
    return packed.unionByName(empty)

"""Near-duplicates by SimHash, with vantage-point trees over the fingerprints.

Fingerprint: A-Z are lower-cased, words are runs without ASCII white space, shingles are `width`
words joined by spaces (fewer words: the whole sequence; none, or a null text: fingerprint zero).
A bit is one if it is set in over half of the shingles' XXH64 values, repeats counted.

Search: two fingerprints within `bits` differ in at most bits // blocks places of at least one of
`blocks` groups of bits. Each group has a vantage-point tree over the Hamming distance inside it.
A node's children are the distances from its vantage point (one per level), so a leaf is a
vector of distances. A fingerprint lives in its own leaf, and visits those leaves the triangle bound
cannot exclude: a point at distance d moves each distance by at most d, and by an amount as even
or odd as d. Of two leaves that could meet, one visits the other. Leaves are the shards; inside one,
whole fingerprints are compared, so the links are exact. The depth follows the number of different
fingerprints, so a leaf keeps its size as a corpus grows. A leaf over `leaf_rows` is cut into
tiles, each pair of its parts in one, so no task holds more.

Equal fingerprints are one node (its smallest id), and a leaf reports a spanning forest of its links
instead of all pairs, so groups of copies cost no more than their rows.

Nulls: a row without an id keeps its fingerprint and has no component. Repeated rows fall into one
node. An empty table gives an empty result. Only id and text are read from the input.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.session import settle

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    found = (text or "").encode().translate(LOWER).split()
    if not found:
        return 0
    joined, n = b" ".join(found), len(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(width, n) - 1
    total, hashed, digest = np.zeros(64, np.int64), n - span, xxhash.xxh64_intdigest
    for low in range(0, hashed, 1 << 16):
        high = min(hashed, low + (1 << 16))
        values = np.array([digest(joined[a:b], seed) for a, b in zip(starts[low:high].tolist(), ends[low + span : high + span].tolist(), strict=True)], dtype=">u8")
        total += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > hashed).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, seed: int = 42) -> DataFrame:
    """`doc_id` and `fp` (the fingerprint as a signed long) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(x.as_py(), width, seed) for x in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def vantage_points(masks: list[int], levels: int) -> list[list[int]]:
    """One pattern per bit group and level: the hash of its number, cut to the group."""
    return [[xxhash.xxh64_intdigest(f"{b}/{level}") & mask for level in range(levels)] for b, mask in enumerate(masks)]


def visited(levels: int, reach: int) -> list[tuple[int, ...]]:
    """Offsets of the leaves that the triangle bound leaves open within `reach`, one of each opposite two."""
    offsets = {o for d in range(reach + 1) for o in product(range(-d, d + 1, 2), repeat=levels)}
    return sorted(o for o in offsets if o >= tuple(-x for x in o))


def bit_groups(blocks: int) -> list[int]:
    edges = [64 * b // blocks for b in range(blocks + 1)]
    return [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]


def signed(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def leaves(nodes: DataFrame, levels: int, blocks: int, bits: int) -> DataFrame:
    """Each node in its own leaf of every tree and in those it visits: cell, fp, id, home."""
    masks = bit_groups(blocks)
    steps = visited(levels, bits // blocks)
    keys = []
    for b, (mask, points) in enumerate(zip(masks, vantage_points(masks, levels), strict=True)):
        part = F.col("fp").bitwiseAND(signed(mask))
        key = F.lit(b).cast("long")
        for point in points:
            key = key * 128 + 32 + F.bit_count(part.bitwiseXOR(signed(point)))
        keys.append(key)
    shifts = [sum(o * 128 ** (levels - 1 - i) for i, o in enumerate(step)) for step in steps]
    rows = nodes.select("fp", "id", F.explode(F.array(*keys)).alias("key"))
    moved = F.explode(F.array(*(F.lit(s).cast("long") for s in shifts))).alias("shift")
    return rows.select("fp", "id", "key", moved).select((F.col("key") + F.col("shift")).alias("cell"), "fp", "id", (F.col("shift") == 0).alias("home"))


def merge(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of linked places; a parent is never larger than its child."""
    while len(i):
        a, b = parent[i], parent[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent[:] = up


def leaf_forest(fp: np.ndarray, ids: np.ndarray, home: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each linked id of a leaf with the smallest id it is tied to. Visitors are compared with residents only."""
    order = np.lexsort((ids, ~home))
    fp, ids, home = fp[order].view(np.uint64), ids[order], home[order]
    residents, rank = int(home.sum()), np.argsort(np.argsort(ids, kind="stable"), kind="stable")
    parent, step = np.arange(len(ids)), max(1, (1 << 20) // max(1, residents))
    for low in range(0, len(fp), step):
        near = np.bitwise_count(fp[low : low + step, None] ^ fp[None, :residents]) <= bits
        i, j = np.nonzero(near)
        later = i + low > j
        merge(parent, rank[i[later] + low], rank[j[later]])
    ordered = np.sort(ids)
    tied = np.nonzero(parent != np.arange(len(ids)))[0]
    return ordered[tied], ordered[parent[tied]]


def links(nodes: DataFrame, bits: int = 4, blocks: int = 3, leaf_rows: int = 8192, leaf_mean: int = 512) -> DataFrame:
    """Edges (a, b) between ids whose fingerprints differ in at most `bits` places, enough to connect all such pairs.

    `nodes` has one row per fingerprint: fp, id.
    """
    levels = max(1, math.ceil(math.log(max(1, nodes.count() / leaf_mean), 8)))
    rows = leaves(nodes, levels, blocks, bits)
    large = rows.groupBy("cell").count().where(F.col("count") > leaf_rows).select("cell", F.ceil(F.col("count") / leaf_rows).alias("parts"))
    rows = rows.join(large, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")
    rows = rows.select("cell", "fp", "id", "home", part.alias("part"), "parts", other)
    tile = F.least("part", "other") * F.col("parts") + F.greatest("part", "other")
    rows = rows.select("cell", tile.alias("tile"), "fp", "id", "home")

    def forest(leaf: pd.DataFrame) -> pd.DataFrame:
        a, b = leaf_forest(leaf["fp"].to_numpy(), leaf["id"].to_numpy(), leaf["home"].to_numpy(dtype=bool), bits)
        return pd.DataFrame({"a": a, "b": b})

    return rows.groupBy("cell", "tile").applyInPandas(forest, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest id reachable over links) of every row."""
    prints = settle(fingerprints(docs, doc_id, text, width, seed))
    nodes = settle(prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("id")))
    found = components(links(nodes, bits))
    named = nodes.join(found, "id", "left").select("fp", F.coalesce("component", "id").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("component"))
    return prints.join(named, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), component.alias("component_id"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 4) -> DataFrame:
    """The documents with one of each group: the row with the group's smallest id, once if rows repeat; rows without an id all stay."""
    kept = near_duplicates(docs, doc_id, text, bits).where("doc_id = component_id").select(F.col("doc_id").alias(doc_id)).distinct()
    named = docs.where(F.col(doc_id).isNotNull()).join(kept, doc_id, "left_semi").dropDuplicates([doc_id])
    return named.unionByName(docs.where(F.col(doc_id).isNull())).select(*docs.columns)

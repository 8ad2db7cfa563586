"""Near-copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Texts with equal sets are one node. Two searches find candidate pairs of nodes, and only pairs whose sets reach 0.8 are links:

* The vantage-point trees of `simhash` over the nodes' 64-bit fingerprints, within `bits` places: this ties most copies.
* A prefix join, which leaves no pair out. Shingles have one fixed order, rare ones first. Two sets of similarity 0.8 share
  at least one of the first n - ceil(0.8 n) + 1 shingles of each, so nodes meet on these alone. Shingles held by one
  row only are dropped; nodes that meet must have sizes and places in the order that allow the similarity.

The order needs no exact counts: shingles are counted in `cells` hash cells over all rows, so a passage that many documents
share comes late in each, and is met only by documents that are mostly such passages. The table of cells has a fixed size.

No group is compared pair by pair at once. First each node of a key is paired with two others of it (`neighbours`), and confirmed
pairs make components; a dense group of copies ends here. Then only nodes of different components are paired, in tiles of
bounded rows where a key holds very many. Before a set is read again, the counts of its shingles in 64 buckets must allow the
link (sets differ at least as much as these counts). Sets are sent pair by pair, never by group, and a text is hashed in slices of words.

Identities have 128 bits. Links run on 60 bits of a set's, and the few sets that share these are told apart by a list.

Nulls: rows without an id all stay. Null and empty texts have the empty set and are copies of each other; texts under five words
are one shingle. Rows that share an id but not the text are separate rows: one goes only for a row of its own component, the one
with the smallest id and, of these, the smallest hash of all columns; rows repeated in every column count once. Very long
texts are compared whole, an empty table gives an empty result, and columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.components import components
from tidemark.llm.importance import slices
from tidemark.llm.line_dedup import two_hashes
from tidemark.session import settle

BUCKETS = 64
SPARE = 4
MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(texts: pa.Array, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every word of an array of texts, A-Z lower-cased, and where each text's words begin and end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    held = pc.not_equal(flat, "")
    encoded = flat.filter(held).dictionary_encode()
    bounds = np.searchsorted(owner.filter(held).to_numpy(), np.arange(len(texts) + 1))
    hashes = np.array([xxhash.xxh64_intdigest(word, seed) for word in encoded.dictionary.cast(pa.binary()).to_pylist()], dtype=np.uint64)
    return hashes[encoded.indices.to_numpy()], bounds


def mixed(words: np.ndarray, width: int) -> np.ndarray:
    """One value for each run of `width` word hashes, in order; one for all words if they are fewer."""
    if not len(words):
        return words
    span = min(width, len(words))
    last = len(words) - span + 1
    values = words[:last].copy()
    for k in range(1, span):
        values = (values ^ (values >> np.uint64(29))) * MIX + words[k : last + k]
    values = (values ^ (values >> np.uint64(32))) * MIX
    return values ^ (values >> np.uint64(29))


def shingles(texts: pa.Array, width: int = 5, seed: int = 42) -> Iterator[np.ndarray]:
    """Of each text the 64-bit values of its shingles, in order, repeats kept."""
    for low, high in slices(texts):
        hashes, bounds = word_hashes(texts[low:high], seed)
        for k in range(high - low):
            yield mixed(hashes[bounds[k] : bounds[k + 1]], width)


def fingerprint(values: np.ndarray) -> int:
    """The SimHash of shingle values, unsigned."""
    total = np.zeros(64, np.int64)
    for low in range(0, len(values), 1 << 16):
        total += np.unpackbits(values[low : low + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(values)).tobytes(), "big")


def bucket_counts(each: np.ndarray) -> np.ndarray:
    """How many values of a set fall in each bucket, 255 at most."""
    return np.minimum(np.bincount((each % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS), 255).astype(np.uint8)


def set_id(each: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(each.tobytes())


def node_of(identity: bytes, id_bits: int, apart: dict[bytes, int]) -> int:
    """A signed long: the first bits of the identity, and a number for the few that share them."""
    short = int.from_bytes(identity[:8], "big") >> (64 - id_bits) << SPARE
    return (short | apart.get(identity, 0)) - (1 << 63)


def prints(docs: DataFrame, doc_id: str, text: str, width: int, seed: int, id_bits: int, cells: int) -> DataFrame:
    """r1, r2 (of the row), doc_id, set_id, node (without spare numbers), fp, n (size of the set) and counts of every row,
    and for each task its rows by cell of shingles, as `slice` and `seen` (32-bit counts)."""
    part = min(cells, 1 << 14)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, any_row = np.zeros(cells, np.uint32), False
        for batch in batches:
            ids, nodes, fps, sizes, counts = [], [], [], [], []
            for values in shingles(batch.column(3), width, seed):
                each = np.unique(values)
                np.add.at(seen, (each % np.uint64(cells)).astype(np.int64), 1)
                ids.append(set_id(each))
                nodes.append(node_of(ids[-1], id_bits, {}))
                fps.append(fingerprint(values))
                sizes.append(len(each))
                counts.append(bucket_counts(each).tobytes())
            any_row |= len(ids) > 0
            rows = [*batch.columns[:3], pa.array(ids, pa.binary()), pa.array(nodes, pa.int64()), pa.array(np.array(fps, dtype=np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays([*rows, pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary())], names=names)
        if any_row:
            pieces = [seen[low : low + part].tobytes() for low in range(0, cells, part)]
            empty = [pa.nulls(len(pieces), pa.binary() if name in ("set_id", "counts") else pa.int64()) for name in names[:8]]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.binary())], names=names)

    names = ["r1", "r2", "doc_id", "set_id", "node", "fp", "n", "counts", "slice", "seen"]
    r1, r2 = two_hashes(*(F.col(c) for c in docs.columns))
    rows = docs.select(r1.alias("r1"), r2.alias("r2"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "r1 long, r2 long, doc_id long, set_id binary, node long, fp long, n long, counts binary, slice int, seen binary")


def levels(found: DataFrame, cells: int) -> np.ndarray:
    """How common the shingles of each cell are: four steps to a doubling, one byte a cell. Tasks are added up in two steps;
    only the bytes come to the driver."""

    def added(table: pa.Table, last: bool) -> pa.Table:
        total = sum(np.frombuffer(x, np.uint32).astype(np.int64) for x in table.column("seen").to_pylist())
        whole = np.minimum(total, (1 << 32) - 1).astype(np.uint32)
        whole = np.floor(4 * np.log2(np.maximum(whole, 1))).astype(np.uint8) if last else whole
        return pa.table({"slice": pa.array([table.column("slice")[0].as_py()], pa.int32()), "seen": pa.array([whole.tobytes()], pa.binary())})

    def some(table: pa.Table) -> pa.Table:
        return added(table, False)

    def every(table: pa.Table) -> pa.Table:
        return added(table, True)

    seen = found.where("slice IS NOT NULL").select("slice", "seen", F.pmod(F.xxhash64("seen"), F.lit(64)).alias("some"))
    seen = seen.groupBy("slice", "some").applyInArrow(some, "slice int, seen binary").groupBy("slice").applyInArrow(every, "slice int, seen binary")
    pieces = [row.seen for row in seen.orderBy("slice").collect()]  # a fixed number of cells
    return np.frombuffer(b"".join(pieces), np.uint8) if pieces else np.zeros(cells, np.uint8)


def prefix(each: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The first n - ceil(0.8 n) + 1 shingles of a set, least common cells first, then by value."""
    n = len(each)
    if not n:
        return each
    common = order[(each % np.uint64(len(order))).astype(np.int64)]
    upto = n - -(-4 * n // 5) + 1
    # Only those up to the last level needed are sorted.
    last = np.partition(common, upto - 1)[upto - 1]
    few = np.nonzero(common <= last)[0]
    return each[few[np.lexsort((each[few], common[few]))[:upto]]]


def prefixes(docs: DataFrame, text: str, width: int, seed: int, id_bits: int, apart: dict[bytes, int], order: np.ndarray) -> DataFrame:
    """node, n and keys (its prefix) of the texts; copies within a batch once."""
    shipped = docs.sparkSession.sparkContext.broadcast(order)  # a byte a cell

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, keys, told = [], [], [], set()
            for values in shingles(batch.column(0), width, seed):
                each = np.unique(values)
                node = node_of(set_id(each), id_bits, apart)
                if len(each) and node not in told:
                    told.add(node)
                    nodes.append(node)
                    sizes.append(len(each))
                    keys.append(prefix(each, shipped.value).view(np.int64))
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), lists], names=["node", "n", "keys"])

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "node long, n long, keys array<long>")


def meetings(keyed: DataFrame, tile_rows: int) -> DataFrame:
    """key, node, n, at (place in the node's order), part of parts (a power of two): nodes by each shingle that several rows hold in their prefixes."""
    each = keyed.select("node", "n", F.posexplode("keys").alias("at", "key"))
    shared = settle(each.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1").select("key"))
    met = settle(each.join(shared, "key").distinct())
    large = met.groupBy("key").count().where(F.col("count") > tile_rows).select("key", F.expr(f"shiftleft(1L, cast(ceil(log2(count / {tile_rows})) as int))").alias("parts"))
    parted = met.join(large, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    return parted.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))


def may_link(x: str, y: str) -> str:
    """Whether sizes, and what is left of both orders from a common shingle on, allow the similarity."""
    sizes = f"5 * least({x}.n, {y}.n) >= 4 * greatest({x}.n, {y}.n)"
    return f"({sizes} AND 9 * least({x}.n - {x}.at, {y}.n - {y}.at) >= 4 * ({x}.n + {y}.n))"


def neighbours(met: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes of a key: each with the one before it by size, and with the one that has the key earliest in its order.

    That one has the fewest rare shingles: where copies were made from one text, it is the text itself.
    """
    cell = Window.partitionBy("key", "part")
    by_size, by_place = cell.orderBy("n", "node"), cell.orderBy("at", "node")
    own = F.struct("node", "n", "at")
    others = F.array(F.lag(own).over(by_size), F.first(own).over(by_place))
    rows = met.select(own.alias("x"), others.alias("others")).select("x", F.explode("others").alias("y"))
    rows = rows.where("y.node <> x.node").where(may_link("x", "y"))
    return rows.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def across(met: DataFrame, tied: DataFrame) -> DataFrame:
    """Pairs (a, b) of all nodes of a key that are in different components, tile by tile."""
    named = settle(met.join(tied.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node")))
    mixed_keys = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    rows = settle(named.join(mixed_keys, "key", "left_semi"))
    x = rows.select("key", "node", "n", "at", "component", "part", F.explode(F.sequence("part", F.col("parts") - 1)).alias("to")).alias("x")
    y = rows.select("key", "node", "n", "at", "component", "part", F.explode(F.sequence(F.lit(0).cast("long"), "part")).alias("to")).alias("y")
    same = F.expr("x.key = y.key AND x.part = y.to AND x.to = y.part AND x.component <> y.component AND (x.part < y.part OR x.node < y.node) AND " + may_link("x", "y"))
    return x.join(y, same).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def wanted_sets(docs: DataFrame, wanted: DataFrame, text: str, width: int, seed: int, most_sent: int = 200_000) -> DataFrame:
    """node and shingles (sorted 64-bit values) of the nodes `wanted` (node, r1, r2: one row with that set).

    Up to `most_sent` rows of three longs go to the texts; beyond, texts and rows meet by their hashes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.unique(x).tobytes() for x in shingles(batch.column(1), width, seed)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], names=["node", "shingles"])

    keys = wanted.select("node", F.col("r1").alias("__r1"), F.col("r2").alias("__r2"))
    keys = F.broadcast(keys) if wanted.count() <= most_sent else keys
    r1, r2 = two_hashes(*(F.col(c) for c in docs.columns))
    texts = docs.select(r1.alias("__r1"), r2.alias("__r2"), F.col(text).cast("string").alias("__text")).join(keys, ["__r1", "__r2"])
    return texts.select("node", "__text").mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, text: str, width: int, seed: int) -> DataFrame | None:
    """Those of the pairs (a, b) whose sets have a Jaccard similarity of 0.8 or more; None if no pair may have."""

    def possible(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, BUCKETS).astype(np.int16) for k in (2, 3))
            apart = np.abs(x - y).sum(axis=1, dtype=np.int64)
            yield batch.select([0, 1]).filter(pa.array(9 * apart <= batch.column(4).to_numpy()))

    def similar(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = zip(batch.column(2), batch.column(3), strict=True)
            x_y = ((np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in sets)
            held = [9 * len(np.intersect1d(x, y, assume_unique=True)) >= 4 * (len(x) + len(y)) for x, y in x_y]
            yield batch.select([0, 1]).filter(pa.array(held, pa.bool_()))

    side = lambda end: nodes.select(F.col("node").alias(end), F.col("counts").alias(f"counts_{end}"), F.col("n").alias(f"n_{end}"))
    sized = settle(pairs.distinct()).join(side("a"), "a").join(side("b"), "b").where("5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)")
    near = settle(sized.select("a", "b", "counts_a", "counts_b", (F.col("n_a") + F.col("n_b")).alias("n")).mapInArrow(possible, "a long, b long"))
    if not near.limit(1).count():
        return None
    ends = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    sets = settle(wanted_sets(docs, settle(nodes.select("node", "r1", "r2").join(ends, "node", "left_semi")), text, width, seed))
    both = near.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    return settle(both.select("a", "b", "x", "y").mapInArrow(similar, "a long, b long"))


def joined_components(tied: DataFrame, more: DataFrame) -> DataFrame:
    """id and component after links `more` between components: only these, not all ties, are contracted."""
    named = tied.select("id", "component")
    end = lambda name: more.select(F.col(name).alias("id"), F.struct("a", "b").alias("link")).join(named, "id", "left").select("link", F.coalesce("component", "id").alias(name))
    upper = components(end("a").join(end("b"), "link").select("a", "b"))
    upper = settle(upper.select(F.col("id").alias("lower"), F.col("component").alias("upper")))
    moved = named.join(upper, F.col("component") == F.col("lower"), "left").select("id", F.coalesce("upper", "component").alias("component"))
    # A node with no tie before is an end of its own.
    return moved.unionByName(upper.join(named, F.col("lower") == F.col("id"), "left_anti").select(F.col("lower").alias("id"), F.col("upper").alias("component")))


def told_apart(nodes: DataFrame, most: int = 10_000) -> dict[bytes, int]:
    """Numbers for the sets that share the short identity with another: none but by chance, about n² / 2^61 pairs."""
    shared = nodes.groupBy("node").count().where("count > 1")
    found = nodes.join(shared, "node", "left_semi").select("node", "set_id").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError("too many sets share a short identity")
    groups: dict[int, list[bytes]] = {}
    for row in found:
        groups.setdefault(row.node, []).append(bytes(row.set_id))
    if any(len(x) > 1 << SPARE for x in groups.values()):
        raise ValueError("too many sets share one short identity")
    return {identity: k for held in groups.values() for k, identity in enumerate(sorted(held))}


def linked(docs: DataFrame, doc_id: str, text: str, width: int, seed: int, bits: int, cells: int, id_bits: int, tile_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows (r1, r2, doc_id, set_id, component's node if it has a link) and nodes of the documents with an id."""
    found = settle(prints(docs, doc_id, text, width, seed, id_bits, cells))
    rows = found.where("slice IS NULL")
    least = F.min(F.struct("r1", "r2")).alias("row")
    nodes = settle(rows.groupBy("set_id").agg(F.first("node").alias("node"), F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("counts").alias("counts"), least).select("set_id", "node", "fp", "n", "counts", "row.r1", "row.r2"))
    apart = told_apart(nodes)
    if apart:
        number = F.create_map(*(x for k, v in apart.items() for x in (F.lit(k.hex()), F.lit(v))))
        numbered = F.col("node") + F.coalesce(F.element_at(number, F.lower(F.hex("set_id"))), F.lit(0))
        nodes, rows = nodes.withColumn("node", numbered), rows.withColumn("node", numbered)
    met = meetings(settle(prefixes(docs, text, width, seed, id_bits, apart, levels(found, cells))), tile_rows)
    # Each search is a plan of its own: the driver's memory follows the largest plan.
    trees = settle(simhash.links(nodes.where("n > 0").select("fp", F.col("node").alias("id")), bits))
    ties = confirmed(neighbours(met).unionByName(trees.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))), docs, nodes, text, width, seed)
    if ties is None:
        ties = nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    tied = settle(components(ties))
    more = confirmed(across(met, tied), docs, nodes, text, width, seed)
    return rows, tied if more is None else settle(joined_components(tied, more))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, seed: int = 42, bits: int = 4, cells: int = 1 << 20, id_bits: int = 60, tile_rows: int = 1024) -> DataFrame:
    """The documents with one of each group of near-copies, once if rows repeat; rows without an id all stay."""
    named = docs.where(F.col(doc_id).isNotNull())
    rows, found = linked(named, doc_id, text, width, seed, bits, cells, id_bits, tile_rows)
    each = rows.groupBy("node", "doc_id", "r1", "r2").agg(F.count(F.lit(1)).alias("n_rows"))
    each = each.join(found.withColumnRenamed("id", "node"), "node", "left").select(F.coalesce("component", "node").alias("component"), "doc_id", "r1", "r2", "n_rows")
    kept = settle(each.groupBy("component").agg(F.min(F.struct("doc_id", "r1", "r2", "n_rows")).alias("kept")).select(F.col("kept.r1").alias("__k1"), F.col("kept.r2").alias("__k2"), "kept.n_rows"))
    r1, r2 = two_hashes(*(F.col(c) for c in docs.columns))
    keyed = named.withColumns({"__r1": r1, "__r2": r2})
    same = (F.col("__r1") == F.col("__k1")) & (F.col("__r2") == F.col("__k2"))
    out = keyed.join(kept.where("n_rows = 1"), same, "left_semi")
    repeated = kept.where("n_rows > 1")
    if repeated.limit(1).count():
        out = out.unionByName(keyed.join(repeated, same, "left_semi").dropDuplicates(["__r1", "__r2"]))
    return out.select(*docs.columns).unionByName(docs.where(F.col(doc_id).isNull()))

"""Exact top-k inner products by Fagin's threshold algorithm.

Candidates are cut into shards by a hash of their row numbers and queries into blocks; each (block, shard)
is one group. A shard keeps one sorted list per dimension. The queries of a block walk all lists together,
from both ends, so that the vectors are met in one order for all of them; those met in a step are scored
for all queries that still go on by one product of matrices. A query stops when the best score
still possible for an unseen vector (the sum over dimensions of its component times the last value
read at the end it prefers) is below its k-th score; at equality it goes on, since ties go to the smaller id.
The shards' answers are merged by rank.

Groups hold at most about `shard_rows` candidates and `block_rows` queries, whatever the table. The
work is queries times candidates at worst, spread over the groups.

Components are quantised to floor(scale * x), held as doubles, which are exact for whole numbers of
that origin whatever their size. Scores are exact: in doubles where no partial sum can pass 2^53, else
in Python integers. A returned score that no long holds ends the job with an error.

Vectors that are null or hold null or non-finite components, and rows without an id, take no part.
Shorter vectors count as padded with zeros. Rows that share an id are rows of their own: each asks if
its id is selected, with the others among its candidates, so that such an id has every rank as often as it
has rows. With fewer than k candidates all are returned; empty tables and query sets give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle

WHOLE = float(1 << 53)


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 64) -> DataFrame:
    """row, vec_id and vector (whole numbers as array of double), one row per usable vector."""
    usable = F.forall(F.col(embedding), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < WHOLE, F.floor(scaled).cast("double")).otherwise(scaled)  # from 2^53 on every double is whole

    rows = vectors.where(F.col(vec_id).isNotNull() & usable)
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"), F.transform(F.col(embedding), whole).alias("vector"))


def integers(whole: np.ndarray) -> np.ndarray:
    """Python integers of whole doubles."""
    return np.array([int(x) for x in whole.ravel().tolist()], dtype=object).reshape(whole.shape)


def merged(best: np.ndarray, best_ids: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
    """Put scores (a row for each query, a column for each id) among the k best of each query, largest first, ties by id."""
    k, least = best.shape[1], best[:, -1]
    if scores.dtype != object and scores.shape[1] > k:
        least = np.maximum(least, np.partition(scores, -k, axis=1)[:, -k])
    query, at = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
    some = np.unique(query)
    query, found, names = np.concatenate((np.repeat(some, k), query)), np.concatenate((best[some].ravel(), scores[query, at])), np.concatenate((best_ids[some].ravel(), ids[at]))
    level = found if found.dtype != object else np.unique(found, return_inverse=True)[1]
    order = np.lexsort((names, -level, query))
    query, found, names = query[order], found[order], names[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    top = rank < k
    best[query[top], rank[top]], best_ids[query[top], rank[top]] = found[top], names[top]


def walk(rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, query_rows: np.ndarray, queries: np.ndarray, k: int, first: int = 16, scored: int = 1024) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the query, vec_id and score of each query's k best in one shard; lists are read in steps that double."""
    n, width = vectors.shape
    largest = max(1.0, float(np.abs(vectors).max(initial=0))) * max(1.0, float(np.abs(queries).max(initial=0))) * max(1, width)
    if largest >= WHOLE:
        vectors, queries = integers(vectors), integers(queries)
    order = np.argsort(vectors, axis=0, kind="stable")
    ordered = np.take_along_axis(vectors, order, axis=0)
    place = np.empty(order.shape, np.int64)
    np.put_along_axis(place, order, np.arange(n)[:, None], axis=0)
    # A vector is met as soon as one of its components is read, from whichever end.
    met = np.minimum(place, n - 1 - place).min(axis=1) if width else np.zeros(n, np.int64)
    sequence = np.argsort(met, kind="stable")
    rows, ids, vectors, met = rows[sequence], ids[sequence], vectors[sequence], met[sequence]
    own = np.full(len(queries), -1)
    _, at, asks = np.intersect1d(rows, query_rows, return_indices=True)
    own[asks] = at
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    best, best_ids = np.full((len(queries), k), -np.inf, vectors.dtype), np.full((len(queries), k), np.iinfo(np.int64).max)
    going, depth, step, done = np.arange(len(queries)), 0, first, 0
    while done < n and len(going):
        depth, step = min(n, depth + step), step * 2
        upto = int(np.searchsorted(met, depth))
        held, held_ids, asked, self_at = best[going], best_ids[going], queries[going], own[going]
        for low in range(done, upto, scored):
            high = min(upto, low + scored)
            scores = asked @ vectors[low:high].T
            itself = np.nonzero((self_at >= low) & (self_at < high))[0]
            scores[itself, self_at[itself] - low] = -np.inf
            merged(held, held_ids, scores, ids[low:high])
        best[going], best_ids[going], done = held, held_ids, upto
        if done < n:
            bound = up[going] @ ordered[n - depth] + down[going] @ ordered[depth - 1]
            going = going[bound >= held[:, -1]]
    query, rank = np.nonzero(best > -np.inf)
    return query, best_ids[query, rank], best[query, rank]


def search(vectors: DataFrame, queries: Column, k: int = 20, shard_rows: int = 8192, block_rows: int = 2048, **options) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of all other vectors for each row that `queries` (a condition on vec_id) selects."""
    rows = settle(quantised(vectors, **options))
    n, n_queries, width = rows.agg(F.count(F.lit(1)), F.count_if(queries), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_queries // block_rows))
    padded = F.concat(F.col("vector"), F.array_repeat(F.lit(0.0), F.lit(width) - F.size("vector"))).alias("vector")
    own = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("row", F.lit("block")), F.lit(blocks)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    groups = rows.select(every(blocks).alias("block"), own.alias("shard"), "row", "vec_id", padded, F.lit(False).alias("asks")).unionByName(
        rows.where(queries).select(block.alias("block"), every(shards).alias("shard"), "row", "vec_id", padded, F.lit(True).alias("asks"))
    )

    def answer(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        ids, rows = table.column("vec_id").to_numpy(), table.column("row").to_numpy()
        matrix = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), width)
        at, found, scores = walk(rows[~asks], ids[~asks], matrix[~asks], rows[asks], matrix[asks], k)
        scores = pa.array(list(map(int, scores.tolist())), pa.int64())
        return pa.table({"query_row": rows[asks][at], "query_id": ids[asks][at], "vec_id": found, "score": scores})

    found = groups.groupBy("block", "shard").applyInArrow(answer, "query_row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

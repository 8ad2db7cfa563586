"""Importance resampling of documents towards a target, on hashed word n-grams.

A feature is a run of 1 to `order` consecutive words (A-Z lower-cased; words are runs of ASCII letters,
digits and all characters beyond ASCII), joined by a space and hashed by CRC-32 into `buckets`. A
bucket's gain is the floored, scaled log ratio of its smoothed frequencies in the target and in
the corpus. A document weighs the sum of its features' gains; a Gumbel term from a hash of its id, added to
that, turns "the n highest" into a draw without replacement in proportion to the weights.

Features are made by Arrow kernels, some megabytes of text at a time: ascii_lower, split_pattern_regex, list_flatten
and dictionary_encode. Longer runs are pairs of a shorter run's index and the dictionary index shifted to the next
word. Only distinct words and pairs are hashed (a run's CRC goes on from the shorter run's); take carries buckets
and gains back to the words, and differences of one running sum are the sums of each text.

The corpus is read twice, once to count buckets and once to weigh. A task sends at most one row a bucket, so the
two tables of counts and the gains, which go through the driver, have `buckets` rows, whatever the corpus. The draw
ranks by ranges: rows are cut by sampled bounds of (score, id), numbered in their range, and offset by the rows of the ranges before.

Memory is that of one slice of texts, or of the longest text. Nulls: a null text has no words and weighs 0, like an empty
one. A row without an id has no hash: its score is null and it is never drawn. Rows that share an id have
the same random term and are ranked apart, in any order. An empty corpus or target counts as zeros. Only id and text are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SLICE_BYTES = 4 << 20


def hashed_features(texts: pa.Array, order: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of an array of texts: words per text, and bucket and text number of every feature, texts ascending."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=BETWEEN)
    flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    held = pc.not_equal(flat, "")
    flat, owner = flat.filter(held), owner.filter(held).to_numpy()
    n_words = np.bincount(owner, minlength=len(texts))
    encoded = flat.dictionary_encode()
    words = [word.encode() for word in encoded.dictionary.to_pylist()]
    index = encoded.indices.to_numpy().astype(np.int64)
    crcs = [zlib.crc32(word) for word in words]
    run, found, owners = index, [pa.array(crcs, pa.int64()).take(encoded.indices).to_numpy() % buckets], [owner]
    starts = np.arange(len(index))  # of the runs in the making; a run is dropped where its text ends
    for n in range(2, order + 1):
        fits = starts + n - 1 < len(index)
        fits[fits] = owner[starts[fits] + n - 1] == owner[starts[fits]]
        starts, run = starts[fits], run[fits]
        pairs = pa.array(run * max(1, len(words)) + index[starts + n - 1]).dictionary_encode()
        before, after = np.divmod(pairs.dictionary.to_numpy(), max(1, len(words)))
        crcs = [zlib.crc32(b" " + words[j], crcs[i]) for i, j in zip(before.tolist(), after.tolist(), strict=True)]
        run = pairs.indices.to_numpy().astype(np.int64)
        found.append(pa.array(crcs, pa.int64()).take(pairs.indices).to_numpy() % buckets)
        owners.append(owner[starts])
    if order == 1:
        return n_words, found[0], owner
    found, owners = np.concatenate(found), np.concatenate(owners)
    by_text = np.argsort(owners, kind="stable")
    return n_words, found[by_text], owners[by_text]


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Cuts of an array of texts into runs of about SLICE_BYTES; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    low = 0
    while low < len(texts):
        passed = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, passed + SLICE_BYTES, side="right")))
        yield low, high
        low = high


def bucket_counts(texts: DataFrame, text: str, order: int, buckets: int) -> dict[int, int]:
    """How often each bucket occurs among the features of all rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            column = batch.column(0)
            for low, high in slices(column):
                total += np.bincount(hashed_features(column[low:high], order, buckets)[1], minlength=buckets)
        seen = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["bucket", "n"])

    counted = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    return {row.bucket: row.n for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # a row a bucket at most


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """floor(1000 * ln) of the ratio of a bucket's frequencies, each count smoothed by one."""
    all_corpus, all_target = float(sum(corpus.values()) + buckets), float(sum(target.values()) + buckets)
    ratio = lambda b: (target.get(b, 0) + 1.0) * all_corpus / ((corpus.get(b, 0) + 1.0) * all_target)
    return np.array([math.floor(1000 * math.log(ratio(b))) for b in range(buckets)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", order: int = 1) -> DataFrame:
    """doc_id, n_words, n_features and weight (sum of the features' gains) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, sizes, features, weights = batch.column(1), [], [], []
            for low, high in slices(column):
                n_words, found, owner = hashed_features(column[low:high], order, len(gain))
                upto = np.searchsorted(owner, np.arange(high - low + 1))
                summed = np.concatenate(([0], np.cumsum(gain[found])))
                sizes.append(n_words)
                features.append(np.diff(upto))
                weights.append(np.diff(summed[upto]))
            columns = [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (sizes, features, weights)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(seed: str, key: Column) -> Column:
    """A scaled Gumbel term, as a floored long, from the first 32 bits of a SHA-256; null for a null key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / float(1 << 32)))).cast("long")


def numbered(rows: DataFrame, first: int) -> DataFrame:
    """`rank`, from 1, of all rows by descending score, then doc_id; null beyond `first`.

    `rows` is settled. Ranges are numbered alone and offset by the sizes of those before; rows of equal score and id may
    fall into several ranges (`salt`), so no range holds more than its share.
    """
    along = [F.desc("score"), F.asc("doc_id"), F.asc("salt")]
    ranged = settle(rows.repartitionByRange(*along).withColumn("slice", F.spark_partition_id()))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    ahead = ranged.groupBy("slice").count().select("slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    place = F.row_number().over(Window.partitionBy("slice").orderBy(*along))
    ranks = ranged.withColumn("place", place).join(ahead, "slice").withColumn("rank", F.col("ahead") + F.col("place"))
    return ranks.withColumn("rank", F.when(F.col("rank") <= first, F.col("rank"))).drop("slice", "place", "ahead")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, order: int = 1, buckets: int = 10_000, seed: str = "2024", doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and rank (1, 2, 3… by descending score; null if not drawn) of every row.

    Drawn are floor(percent * N / 100) of the N rows with an id and at least `least_words` words.
    """
    gain = gains(bucket_counts(docs, text, order, buckets), bucket_counts(target, target_text, order, buckets), buckets)
    score = F.col("weight") + gumbel(seed, F.col("doc_id"))
    rows = settle(weighed(docs, gain, doc_id, text, order).withColumn("score", score).withColumn("salt", F.rand(7)))
    may = F.coalesce((F.col("n_words") >= least_words) & F.col("score").isNotNull(), F.lit(False))
    n = rows.where(may).count()
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    return numbered(rows.where(may), percent * n // 100).select(*out).unionByName(rows.where(~may).withColumn("rank", F.lit(None).cast("long")).select(*out))

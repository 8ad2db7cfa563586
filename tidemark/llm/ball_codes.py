"""Vector codes by ball k-means: each part of a vector becomes the index of an entry of that part's codebook.

Components are floored to integers, floor(scale * x), and vectors cut into equal consecutive parts. A part's codebook
starts as that part of the rows with the smallest ids. Rounds of exact k-means follow: every part goes to its nearest entry (squared
Euclidean distance, ties to the lower index), entries move to the floored mean of their parts, unused ones stay.

Assignment by balls: the parts that an entry holds from the round before are its ball, round the entry where it is now.
Another entry is a neighbour only if half its distance to the ball's is within the ball's radius. A part whose own
distance is below half of that to the nearest neighbour is in the stable core and keeps its entry unseen. The other parts lie in rings
between the half distances of the neighbours in ascending order, and a part is compared just with the neighbours of its ring and
the rings inside. An entry that has not moved can lose parts only to entries that have, so only these are its neighbours. All
tests are on integers, so codes are those of a full search. Balls are those of one Arrow batch, whose radii are never larger.

Each round is one pass over the rows, each partition for itself: rows go on with new codes, and a task adds one row with its sums by part, entry and
component. Only those go to the driver, added up by Spark: at most parts x entries x (width + 1) numbers. A
round's rows are persisted until the next has been made; a lost executor's partitions are made again from the table, and
integer sums are the same in any order.

Rows whose vector is null or holds a null or non-finite component take no part. Any finite component counts: where int64 could
overflow, a batch is worked in Python integers, and sums travel in limbs of 32 bits; an `error` beyond a long is null,
and so is a label's sum then. Vectors of several widths count as padded with zeros to the widest, and to a multiple of the parts.
Rows without an id are coded, and come last where the first entries are picked; rows with equal ids are picked by vector.
With fewer rows than entries there are fewer entries; an empty table gives an empty result. Only id, vector and label are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.session import settle

LIMB = 32
SUMS = T.ArrayType(T.StructType().add("cell", "integer").add("limb", "integer").add("total", "long"))


def usable(embedding: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    return F.coalesce(F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))), F.lit(False))


def integers(values: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """floor(scale * x), as int64 if all stay within `limit`, else as Python integers."""
    if np.abs(values).max(initial=0) * scale < limit:
        return np.floor(values * scale).astype(np.int64)
    exact = [math.floor(x * scale) if abs(x) * scale < 1e300 else int(x) * scale for x in values.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """An Arrow column of lists as rows of doubles, padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of rows to a row, or of rows to rows."""
    difference = x - y
    return (difference * difference).sum(axis=-1)


def nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The nearest entry of every row by full search, ties to the lower index."""
    best, code = apart(x, book[0]), np.zeros(len(x), np.int64)
    for j in range(1, len(book)):
        found = apart(x, book[j])
        closer = (found < best).astype(bool)
        best, code = np.where(closer, found, best), np.where(closer, j, code)
    return code


def by_balls(x: np.ndarray, code: np.ndarray, book: np.ndarray, moved: np.ndarray) -> np.ndarray:
    """`nearest`, from the codes that were nearest before the entries `moved` took their places in `book`."""
    new = code.copy()
    if not moved.any():
        return new
    for i in np.unique(code).tolist():
        ball = np.nonzero(code == i)[0]
        own = apart(x[ball], book[i])
        gaps = apart(book, book[i])
        others = [j for j in range(len(book)) if j != i and (moved[i] or moved[j]) and gaps[j] <= 4 * own.max()]
        others.sort(key=lambda j: (gaps[j], j))
        if not others:
            continue
        ring = np.searchsorted(gaps[others], 4 * own, side="right")
        best, at = own.copy(), np.full(len(ball), i)
        for k, j in enumerate(others):
            inside = np.nonzero(ring > k)[0]
            found = apart(x[ball[inside]], book[j])
            closer = ((found < best[inside]) | ((found == best[inside]) & (j < at[inside]))).astype(bool)
            best[inside[closer]], at[inside[closer]] = found[closer], j
        new[ball] = at
    return new


def limbs(cells: dict[int, int]) -> list[dict]:
    """Integers of any size by cell, as base 2**32 digits; the highest digit carries the sign."""
    out = []
    for cell, total in cells.items():
        place = 0
        while not -(1 << LIMB) <= total < 1 << LIMB:
            out.append({"cell": cell, "limb": place, "total": total & ((1 << LIMB) - 1)})
            total, place = total >> LIMB, place + 1
        out.append({"cell": cell, "limb": place, "total": total})
    return out


class Codebooks:
    """Entries by part, `book[part][entry][component]`, in Python integers, and which of them the last update moved."""

    def __init__(self, book: list, moved: list, scale: int):
        self.book, self.moved, self.scale = book, moved, scale
        self.parts, self.entries, self.width = len(book), len(book[0]), len(book[0][0])

    @property
    def limit(self) -> int:
        """Components below this cannot overflow int64 in four times a squared distance."""
        return math.isqrt((1 << 58) // max(1, self.width))

    def cut(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Rows by part and the codebooks, in one dtype."""
        values = integers(matrix(column, self.parts * self.width), self.scale, self.limit).reshape(-1, self.parts, self.width)
        book = np.array(self.book, dtype=object)
        if values.dtype != object and np.abs(book).max(initial=0) < self.limit:
            return values, book.astype(np.int64)
        return values.astype(object), book

    def assign(self, column: pa.Array, codes: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of every row and part, squared distances summed over parts, and the rows by part."""
        values, book = self.cut(column)
        new, moved = np.zeros(values.shape[:2], np.int64), np.array(self.moved, bool)
        errors = np.zeros(len(values), values.dtype)
        for p in range(self.parts):
            x = values[:, p]
            new[:, p] = nearest(x, book[p]) if codes is None else by_balls(x, codes[:, p], book[p], moved[p])
            errors = errors + apart(x, book[p][new[:, p]])
        return new, errors, values

    def updated(self, totals: dict[int, int]) -> Codebooks:
        """The codebooks after a round, from sums by cell: an entry's count, then its components."""
        book, moved, at = [], [], self.width + 1
        for p in range(self.parts):
            entries, changed = [], []
            for e in range(self.entries):
                first = (p * self.entries + e) * at
                n = totals.get(first, 0)
                entry = [totals.get(first + 1 + c, 0) // n for c in range(self.width)] if n else self.book[p][e]
                entries.append(entry)
                changed.append(entry != self.book[p][e])
            book.append(entries)
            moved.append(changed)
        return Codebooks(book, moved, self.scale)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(c) for part in self.book for entry in part for c in entry).encode()).hexdigest()


def pass_over(rows: DataFrame, books: Codebooks, first: bool) -> DataFrame:
    """Rows with the codes and errors of these codebooks, and a row of sums a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, totals = books.width + 1, {}
        for batch in batches:
            batch = batch.filter(batch.column("embedding").is_valid())
            if not len(batch):
                continue
            before = None if first else np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.int16).reshape(-1, books.parts).astype(np.int64)
            codes, errors, values = books.assign(batch.column("embedding"), before)
            for p in range(books.parts):
                n = np.bincount(codes[:, p], minlength=books.entries)
                sums = np.zeros((books.entries, books.width), values.dtype)
                np.add.at(sums, codes[:, p], values[:, p])
                for e in np.nonzero(n)[0].tolist():
                    cell = (p * books.entries + e) * at
                    for c, more in enumerate([n[e], *sums[e]]):
                        totals[cell + c] = totals.get(cell + c, 0) + int(more)
            small = [x if (x := int(e)) < 1 << 63 else None for e in errors]
            nothing = pa.nulls(len(batch), type=schema_of[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([c.tobytes() for c in codes.astype(np.int16)], pa.binary()), pa.array(small, pa.int64()), nothing], names=names)
        if totals:
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, type=t) for t in schema_of[:-1]), pa.array([limbs(totals)], schema_of[-1])], names=names)

    out = rows.select("vec_id", "label", "embedding").schema.add("codes", "binary").add("error", "long").add("sums", SUMS)
    arrow, names = to_arrow_schema(out), out.names
    schema_of = [arrow.field(name).type for name in names]
    return rows.mapInArrow(run, out)


def sums(coded: DataFrame) -> dict[int, int]:
    """The sums of all tasks by cell: a bounded number of rows, whatever the table."""
    each = coded.where("sums IS NOT NULL").select(F.inline("sums")).groupBy("cell", "limb").agg(F.sum("total").alias("total"))
    totals: dict[int, int] = {}
    for row in each.collect():
        totals[row.cell] = totals.get(row.cell, 0) + (row.total << (LIMB * row.limb))
    return totals


def encode(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """vec_id, label, codes (list of entry indexes, one a part) and error of every usable row, and the codebooks (None without a row)."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("embedding")).where(usable(F.col("embedding")))
    widest = rows.agg(F.max(F.size("embedding"))).first()[0]
    if widest is None:
        return rows.select("vec_id", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error")), None
    width = max(1, -(-widest // parts))
    start = rows.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()  # a codebook's size
    padded = [[*(int(v) for v in integers(np.array(r.embedding, np.float64), scale, 1)), *[0] * (parts * width - len(r.embedding))] for r in start]
    books = Codebooks([[x[p * width : (p + 1) * width] for x in padded] for p in range(parts)], [[True] * len(start)] * parts, scale)
    before = None
    for turn in range(rounds + 1):
        coded = pass_over(rows if before is None else before, books, before is None)
        if turn == rounds:
            break
        coded = coded.persist(StorageLevel.MEMORY_AND_DISK)
        moved = books.updated(sums(coded))
        if before is not None:
            before.unpersist()
        before, books = coded, moved
    code = F.expr(f"transform(sequence(0, {parts - 1}), i -> cast(conv(concat(hex(substring(codes, 2 * i + 2, 1)), hex(substring(codes, 2 * i + 1, 1))), 16, 10) AS int))")
    out = settle(coded.where("codes IS NOT NULL").select("vec_id", "label", code.alias("codes"), "error"))
    return out, books


def digest(coded: DataFrame, books: Codebooks | None) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error (the label's errors, nulls together) and codebooks_sha256."""
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    whole = F.sum(F.col("error").cast("decimal(38,0)"))
    by_label = coded.groupBy(F.col("label").alias("__label")).agg(F.when(F.count("error") == F.count(F.lit(1)), whole).alias("sum"))
    rows = coded.join(by_label, F.col("label").eqNullSafe(F.col("__label")))
    return rows.select("vec_id", code.alias("code"), "error", F.expr("try_cast(sum AS bigint)").alias("label_error"), F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))

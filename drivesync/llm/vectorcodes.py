"""Vector code compression by codebooks, with equal-average search.

Vectors of whole numbers are cut into equal parts; each part is coded by the
nearest entry of the codebook of its position. Entries are sorted by the sum of
their components. The search starts where a part's own sum would stand and goes
outward to both sides; a side ends where the squared gap of the sums, divided by
the number of components, strictly exceeds the best squared distance, which no
entry further out can then reach. Rows with close sums are searched together.

Each round is one pass over the vectors: tasks add up the parts of every entry
and send one row an entry. Only codebooks are in the driver.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drivesync.llm.common import released, slices, stored
from drivesync.llm.vectors import matrix, usable

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Rows searched together, and entries tried at a time on a side.
GROUP = 512
STEP = 16


class EqualAverage:
    """Nearest entries of one codebook (entries x components)."""

    def __init__(self, book: np.ndarray):
        sums = book.sum(1)
        self.order = np.argsort(sums, kind="stable")
        self.book, self.sums = book[self.order], sums[self.order]
        self.squares = (self.book**2).sum(1)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, squared distance) a row; ties to the lower index."""
        index, distance = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        sums = rows.sum(1)
        by_sum = np.argsort(sums, kind="stable")
        for at in range(0, len(rows), GROUP):
            group = by_sum[at : at + GROUP]
            index[group], distance[group] = self._group(rows[group], sums[group])
        return index, distance

    def _group(self, rows, sums):
        count, size = len(self.book), rows.shape[1]
        squares = (rows**2).sum(1)
        best = np.full(len(rows), np.iinfo(np.int64).max)

        def try_entries(low, high):
            nonlocal best
            far = (squares[:, None] - 2 * (rows @ self.book[low:high].T) + self.squares[low:high]).astype(np.int64)
            # Distance first, then the index of the entry.
            best = np.minimum(best, (far * count + self.order[low:high]).min(1))

        def reachable(edge):
            gap = np.abs(sums - self.sums[edge])
            return not (gap * gap > (best // count) * float(size)).all()

        low, high = np.searchsorted(self.sums, [sums[0], sums[-1]])
        low, high = max(0, low - STEP // 2), min(count, high + STEP // 2)
        try_entries(low, high)
        while low > 0 and reachable(low - 1):
            low, end = max(0, low - STEP), low
            try_entries(low, end)
        while high < count and reachable(high):
            high, begin = min(count, high + STEP), high
            try_entries(begin, high)
        return best % count, best // count


def cut(rows: np.ndarray, parts: int) -> np.ndarray:
    """Rows by part, row, component."""
    return np.ascontiguousarray(rows.reshape(len(rows), parts, -1).transpose(1, 0, 2))


def _sums(vectors: DataFrame, books: np.ndarray, scale: int) -> list:
    """``part, entry, n, s0, s1, ...`` of all entries with parts."""
    parts, entries, size = books.shape
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("part", "entry", "n", *(f"s{i}" for i in range(size)))])

    def run(batches):
        searches = [EqualAverage(book) for book in books]
        counts, totals = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, size))
        for batch in (part for whole in batches for part in slices(whole, 4096)):
            for p, rows in enumerate(cut(matrix(batch.column(0), scale), parts)):
                index, _ = searches[p].nearest(rows)
                counts[p] += np.bincount(index, minlength=entries)
                for i in range(size):
                    totals[p, :, i] += np.bincount(index, rows[:, i], entries)
        part, entry = np.nonzero(counts)
        columns = [part, entry, counts[part, entry], *totals[part, entry].T.astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=schema.names)

    found = vectors.select("vector").mapInArrow(released(run), schema)
    return found.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in schema.names[2:]]).collect()


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray:
    """Codebooks (part x entry x component) of ``usable`` vectors.

    They start as the parts of the rows with the least ``vec_id`` (null last,
    then by vector), fewer where there are fewer rows; an entry without parts
    stays. Each round moves an entry to the componentwise floor of the mean of
    its parts.
    """
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
    if not first:
        return np.zeros((parts, 0, 0))
    books = cut(matrix(pa.array([r[0] for r in first], pa.list_(pa.float64())), scale), parts)
    for _ in range(rounds):
        for part, entry, n, *total in _sums(vectors, books, scale):
            books[part, entry] = [t // n for t in total]
    return books


def encode(vectors: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, code, error``: two hex digits of the entry for each part, and
    the squared distance to what the code stands for."""
    schema = T.StructType([*(vectors.schema[c] for c in ("vec_id", "label")),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches):
        searches = [EqualAverage(book) for book in books]
        for batch in (part for whole in batches for part in slices(whole, 4096)):
            codes, error = np.zeros((batch.num_rows, len(books)), np.uint8), np.zeros(batch.num_rows, np.int64)
            for p, rows in enumerate(cut(matrix(batch.column("vector"), scale), len(books))):
                index, distance = searches[p].nearest(rows)
                codes[:, p] = index
                error += distance
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                 pa.array(error)], names=schema.names)

    return vectors.select("vec_id", "label", "vector").mapInArrow(released(run), schema)


def decode(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """``codes`` with ``vector``: the whole numbers that a ``code`` stands for."""
    entries = [F.array(*[F.lit([int(x) for x in entry]) for entry in book]) for book in books]
    picked = [F.get(e, F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")) for p, e in enumerate(entries)]
    return codes.withColumn("vector", F.concat(*picked))


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal numbers, by part, entry, position."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def compress(rows: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of ``vec_id, embedding, label``.

    Rows whose vector is null or empty, holds a null or non-finite component, is
    no multiple of four long, or is of another length than that of the least
    ``vec_id``, are dropped. Rows with a null or repeated ``vec_id`` are rows of
    their own; null labels are one label. Components beyond +-2048 count as that.
    ``label_error`` is null where it exceeds 64 bits. An empty table gives none.
    """
    vectors = usable(rows, PARTS)
    books = fit(vectors)
    coded = stored(encode(vectors, books), "codes")
    sums = coded.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    joined = coded.alias("c").join(sums.alias("s"), F.col("c.label").eqNullSafe(F.col("s.label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))

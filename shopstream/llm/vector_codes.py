"""Vector codes: whole-number vectors in parts, each part replaced by the number of the nearest entry of its codebook.

Distances come from value dictionaries: in every dimension of a block of vectors the distinct numbers are listed once, the squared
differences of each to all entries are tabulated, and the distances of a part are rows of these tables, gathered by
dictionary code and added.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.arrow import batch, map_arrow, narrow
from shopstream.llm.graph import written

# Vectors whose values are listed together, and of those the ones whose distances are held at once.
BLOCK_VECTORS, STRIP_VECTORS = 8192, 512


def sound(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, vector`` without rows whose vector is null or holds a null or non-finite component."""
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return narrow(vectors, vec_id=id_col, label=label_col, vector=vector_col).filter(F.col("vector").isNotNull() & finite)


def whole(column: pa.Array, scale: int) -> np.ndarray:
    """Vectors of one length as rows of floor(scale * x): 64-bit numbers, or unbounded ones where a component needs it."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    length = len(flat) // max(len(column), 1)
    if not len(flat) or np.abs(flat).max() * scale < 1 << 26:
        numbers = np.floor(flat * scale).astype(np.int64)
    else:
        # Doubles of this size have no fraction; below it the product is exact.
        exact = [scale * int(x) if abs(x) >= 1 << 53 else math.floor(x * scale) for x in flat.tolist()]
        numbers = np.array(exact, object)
    return numbers.reshape(len(column), length)


def cuts(length: int, parts: int) -> list[tuple[int, int]]:
    """Begin and end of each part: equal, or as equal as they can be."""
    return [(i * length // parts, (i + 1) * length // parts) for i in range(parts)]


def nearest(part: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest entry, squared distance) of each row; ties go to the lower number."""
    rows, width = part.shape
    index, least = np.zeros(rows, np.int64), np.zeros(rows, np.int64 if part.dtype != object else object)
    if not rows or not width:
        return index, least
    if object in (part.dtype, entries.dtype):
        part, entries = part.astype(object), entries.astype(object)
    low = int(min(part.min(), entries.min()))
    span = int(max(part.max(), entries.max())) - low
    bound = span * span * width
    kind = np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 63 else object
    codes, tables = [], []
    for d in range(width):
        values, code = np.unique(part[:, d], return_inverse=True)
        codes.append(code.reshape(-1))
        # Counted from the least number, so that a narrow type holds them wherever they lie.
        difference = (values - low).astype(kind)[:, None] - (entries[:, d] - low).astype(kind)
        tables.append(difference * difference)
    for start in range(0, rows, STRIP_VECTORS):
        strip = slice(start, start + STRIP_VECTORS)
        distance = tables[0][codes[0][strip]]
        for d in range(1, width):
            distance += tables[d][codes[d][strip]]
        best = distance.argmin(1)
        index[strip] = best
        least[strip] = distance[np.arange(len(best)), best]
    return index, least


def strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for some in batches:
        for start in range(0, some.num_rows, BLOCK_VECTORS):
            yield some.slice(start, BLOCK_VECTORS)


def refined(vectors: DataFrame, books: list[np.ndarray], scale: int) -> list[np.ndarray]:
    """Each entry replaced by the mean of the parts nearest to it, rounded down; entries without parts stay.

    Sums are combined in the task and added by Spark; as many numbers as the codebooks have reach the driver.
    """
    length, parts = sum(b.shape[1] for b in books), len(books)
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        sums = [np.zeros(b.shape, object) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for block in strips(batches):
            v = whole(block.column(0), scale)
            for k, (a, b) in enumerate(cuts(length, parts)):
                index, _ = nearest(v[:, a:b], books[k])
                some = np.zeros(books[k].shape, v.dtype)
                np.add.at(some, index, v[:, a:b])
                sums[k] += some
                counts[k] += np.bincount(index, minlength=len(books[k]))
        for k in range(parts):
            used = np.flatnonzero(counts[k])
            width = books[k].shape[1]
            if len(used) and width:
                yield batch(
                    ["part", "entry", "place", "n", "s"],
                    [
                        pa.array(np.full(len(used) * width, k, np.int32)),
                        pa.array(np.repeat(used, width).astype(np.int32)),
                        pa.array(np.tile(np.arange(width, dtype=np.int32), len(used))),
                        pa.array(np.repeat(counts[k][used], width)),
                        pa.array([int(x) for x in sums[k][used].ravel()], pa.decimal128(28, 0)),
                    ],
                )

    found = map_arrow(vectors.select("vector"), run, "part int, entry int, place int, n bigint, s decimal(28,0)")
    found = found.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toArrow()
    out = [b.copy() for b in books]
    for k, entry, place, n, s in zip(*(found[c].to_pylist() for c in ("part", "entry", "place", "n", "s"))):
        out[k][entry, place] = int(s) // n
    shared.unpersist()
    return out


def codebooks(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> list[np.ndarray]:
    """Codebooks of sound vectors of one length, started from those of the least ids (null last, ties by the vector)."""
    order = F.col("vec_id").asc_nulls_last(), F.col("vector")
    first = vectors.orderBy(*order).limit(entries).select("vec_id", "vector").toArrow()
    start = whole(first["vector"].combine_chunks(), scale)
    books = [start[:, a:b] for a, b in cuts(start.shape[1], parts)]
    for _ in range(rounds):
        books = refined(vectors, books, scale)
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, books: list[np.ndarray], scale: int = 1024) -> DataFrame:
    """``vec_id, label, code, error`` of sound vectors of one length; ``error`` is NULL where it does not fit a long."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        length, parts = sum(b.shape[1] for b in books), len(books)
        for block in strips(batches):
            v = whole(block.column(2), scale)
            codes, error = np.zeros((len(v), parts), np.int64), np.zeros(len(v), v.dtype)
            for k, (a, b) in enumerate(cuts(length, parts)):
                codes[:, k], least = nearest(v[:, a:b], books[k])
                error = error + least
            shown = [bytes(row).hex() for row in codes.astype(np.uint8)]
            fits = [int(e) if e < 1 << 63 else None for e in error.tolist()]
            yield batch(["vec_id", "label", "code", "error"], [block.column(0), block.column(1), pa.array(shown, pa.string()), pa.array(fits, pa.int64())])

    kinds = dict(vectors.dtypes)
    return map_arrow(vectors.select("vec_id", "label", "vector"), run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint")


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", entries: int = 256
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for each sound vector, in four parts of up to 256 ``entries`` each.

    ``label_error`` adds up ``error`` over the rows of an equal label, nulls together. Rows whose vector is null or holds a null or
    non-finite component are left out. Vectors of different lengths have codebooks of their own, a length that four does not divide is cut as
    evenly as it can be, and an empty vector has code 00000000 and error 0. With fewer vectors than entries the
    codebooks are shorter. Repeated vectors get equal codes, a null id stays null and comes last in the start. Numbers too large for 64 bits are computed
    exactly, up to sums of 28 digits, beyond which Arrow raises an error; an error sum that does not fit a long is NULL. Other columns are
    ignored, whatever their names; an empty table gives no row.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code digit pair names one of at most 256 entries")
    kept = written(sound(vectors, id_col, vector_col, label_col).withColumn("size", F.size("vector")), "sound-vectors")
    lengths = sorted(r[0] for r in kept.select("size").distinct().collect())
    made = []
    for length in lengths:
        same = kept.filter(F.col("size") == length)
        books = codebooks(same, entries=entries)
        made.append(encode(same, books).withColumn("codebooks_sha256", F.lit(digest(books))))
    if not made:
        none = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"), F.lit("").alias("codebooks_sha256"))
        made = [none]
    coded = written(reduce(DataFrame.unionByName, made), "vector-codes")
    totals = coded.groupBy(F.col("label").alias("of")).agg(
        F.when(F.count("*") == F.count("error"), F.try_sum("error")).alias("label_error")
    )
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256")

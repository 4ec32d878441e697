"""Arrow plumbing shared by the operators that run Python inside Spark tasks."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# The folder that holds this package.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Bytes of text handled at once inside a task; bounds the memory of vectorised work.
BLOCK_BYTES = 2 << 20
# The same for work that holds many numbers for each byte of text.
SMALL_BLOCK_BYTES = 512 << 10
# Bytes of a group after which a task that works on groups gives memory back.
LARGE_GROUP = 1 << 20


@cache
def _trim() -> Callable[[int], int] | None:
    """The C library's way to give freed memory back, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return None


def give_back() -> None:
    """Return to the system what freed arrays have left with the allocators.

    Python workers outlive their tasks, and those that stand idle count in an executor's memory too.
    """
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)


def lean(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``work`` on groups, giving memory back after large ones."""

    def run(table: pa.Table) -> pa.Table:
        size = table.nbytes
        made = work(table)
        del table
        if size >= LARGE_GROUP:
            give_back()
        return made

    return run


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under fixed names, so that other columns cannot clash with ours."""
    return df.select(*(df[f"`{old}`"].alias(new) for new, old in columns.items()))


def importable(spark: SparkSession) -> None:
    """Let Python workers on machines with this folder import the package, wherever the driver was started.

    On other machines the package has to be installed or sent with ``--py-files``.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_blocks(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Apply ``work`` to consecutive blocks of rows, each of about ``block_bytes``. A task gives its memory back at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = block = made = None
        try:
            for batch in batches:
                for block in blocks(batch, block_bytes):
                    made = work(block)
                    if made is not None:
                        yield made
        finally:
            del batch, block, made
            give_back()

    return map_arrow(df, run, schema)


def blocks(batch: pa.RecordBatch, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch where its rows would exceed ``block_bytes``; a longer row stands alone."""
    rows = batch.num_rows
    if not rows:
        return
    sizes = [0] * rows
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            for i, n in enumerate(pc.binary_length(column).to_pylist()):
                sizes[i] += n or 0
        elif pa.types.is_list(column.type):
            for i, n in enumerate(pc.list_value_length(column).to_pylist()):
                sizes[i] += 8 * (n or 0)
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > block_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    yield batch.slice(start)


def texts(column: pa.Array) -> list[str]:
    """Texts of a column, a null being empty."""
    return [t or "" for t in column.to_pylist()]


def batch(names: list[str], arrays: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in arrays], names)

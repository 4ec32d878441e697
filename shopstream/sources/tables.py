"""Reading and writing Parquet tables by catalog name or by path.

A target holding a slash is a path, anything else a catalog name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.session import scratch_path


def is_path(target: str) -> bool:
    return "/" in target


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, target: str) -> bool:
    """Whether a table has been written under this name or path."""
    if not is_path(target):
        return spark.catalog.tableExists(target)
    fs, jpath = _fs(spark, target)
    return fs.exists(jpath)


def read_table(spark: SparkSession, target: str, merge_schema: bool = False) -> DataFrame:
    """Read a table; ``merge_schema`` unites files written before and after a new column."""
    if not is_path(target):
        return spark.table(target)
    return spark.read.option("mergeSchema", merge_schema).parquet(target)


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Group rows by partition value for few files each.

    The rebalance hint lets adaptive execution cut a hot value into several
    tasks and merge small ones, where a plain repartition would give a value
    holding a third of the table to one task.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_full(
    df: DataFrame, target: str, partition_by: Sequence[str] = (), staged: bool = True
) -> None:
    """Replace a table.

    Path targets are written beside the old version and swapped in at the end, so
    the new content may be computed from the old one and a failed job leaves the
    table as it was.
    """
    spark = df.sparkSession
    if not is_path(target):
        writer = balanced(df, partition_by).write.format("parquet").mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(target)
        return
    target = target.rstrip("/")
    out = f"{target}__new_{uuid.uuid4().hex[:8]}" if staged else target
    writer = balanced(df, partition_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "static").parquet(out)
    if staged:
        swap(spark, out, target)
    spark.catalog.refreshByPath(target)


def swap(spark: SparkSession, staged: str, target: str) -> None:
    fs, new = _fs(spark, staged)
    _, current = _fs(spark, target)
    _, old = _fs(spark, f"{staged}_old")
    had_old = fs.exists(current)
    if had_old and not fs.rename(current, old):
        raise OSError(f"cannot set aside {target}")
    if not fs.rename(new, current):
        if had_old:
            fs.rename(old, current)
        raise OSError(f"cannot move {staged} to {target}")
    if had_old:
        fs.delete(old, True)


def move_files(spark: SparkSession, staged: str, target: str) -> None:
    """Move the data files of a staged table into one with the same partition columns. Their names are unique to the write."""
    fs, new = _fs(spark, staged)
    _, root = _fs(spark, target)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(root)

    def move(source, to) -> None:
        for status in fs.listStatus(source):
            name = status.getPath().getName()
            if status.isDirectory():
                fs.mkdirs(path(to, name))
                move(status.getPath(), path(to, name))
            elif not name.startswith(("_", ".")) and not fs.rename(status.getPath(), path(to, name)):
                raise OSError(f"cannot move {name} to {target}")

    move(new, root)


def append(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a table, creating it if needed."""
    writer = balanced(df, partition_by).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if is_path(target):
        writer.parquet(target)
        df.sparkSession.catalog.refreshByPath(target)
    else:
        writer.format("parquet").saveAsTable(target)


def replace_partitions(df: DataFrame, target: str, partition_by: Sequence[str]) -> None:
    """Replace just the partitions that occur in the frame."""
    (
        balanced(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(target)
    )
    df.sparkSession.catalog.refreshByPath(target)


def swap_partitions(df: DataFrame, target: str, column: str) -> list[str]:
    """Replace just the partitions that occur in the frame, whose rows may be computed from them.

    They are written once, beside the table, and each folder is then moved in; a failed job leaves the table as it was. If it is
    the moving that breaks off, some partitions are new and some old: repeat the change. For tables
    partitioned by one column. Returns the names of the folders.
    """
    spark = df.sparkSession
    staged = f"{target.rstrip('/')}__new_{uuid.uuid4().hex[:8]}"
    balanced(df, [column]).write.partitionBy(column).parquet(staged)
    fs, root = _fs(spark, target.rstrip("/"))
    new, old = _fs(spark, staged)[1], _fs(spark, f"{staged}_old")[1]
    fs.mkdirs(root)
    fs.mkdirs(old)
    path = spark._jvm.org.apache.hadoop.fs.Path
    folders = [n for n in children(spark, staged) if "=" in n]
    for name in folders:
        # A path made from parent and child is taken as it is, so escapes in the name stay.
        current, before = path(root, name), path(old, name)
        had = fs.exists(current)
        if had and not fs.rename(current, before):
            raise OSError(f"cannot set aside {name} of {target}")
        if not fs.rename(path(new, name), current):
            if had:
                fs.rename(before, current)
            raise OSError(f"cannot move {name} to {target}")
    fs.delete(old, True)
    fs.delete(new, True)
    spark.catalog.refreshByPath(target)
    return folders


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, jpath = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    fs, jpath = _fs(spark, path)
    fs.create(jpath, True).close()


def replace_from_itself(df: DataFrame, target: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that occur in a frame computed from them."""
    if len(partition_by) == 1:
        swap_partitions(df, target, partition_by[0])
        return
    # Complete in the shared folder before any old file goes.
    staged = scratch_path(df.sparkSession, "replaced")
    df.write.parquet(staged)
    replace_partitions(df.sparkSession.read.schema(df.schema).parquet(staged), target, partition_by)
    drop_path(df.sparkSession, staged)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, replaced if it is there."""
    fs, jpath = _fs(spark, path)
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    return "\n".join(_lines(spark, path))


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file; nothing behind it is read."""
    return next(_lines(spark, path), "")


def _lines(spark: SparkSession, path: str):
    fs, jpath = _fs(spark, path)
    utf8 = spark._jvm.java.nio.charset.StandardCharsets.UTF_8
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(fs.open(jpath), utf8))
    try:
        while (line := reader.readLine()) is not None:
            yield line
    finally:
        reader.close()


def files(spark: SparkSession, path: str, suffix: str) -> list[tuple[str, int]]:
    """(path, time of change in ms) of the files directly in a folder whose names end in ``suffix``."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    found = [(s.getPath(), s.getModificationTime()) for s in fs.listStatus(jpath) if not s.isDirectory()]
    return [(p.toString(), t) for p, t in found if p.getName().endswith(suffix)]


def stamp(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of change of what lies directly in a folder, as one text that changes with them."""
    fs, jpath = _fs(spark, path)
    found = sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(jpath))
    return repr(found)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table."""
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def in_partitions(column: str, values: Iterable[object]) -> Column:
    """Whether a row lies in one of these partitions, that of NULL included."""
    values = list(values)
    known = F.coalesce(F.col(column).isin([v for v in values if v is not None]), F.lit(False))
    return known | F.col(column).isNull() if None in values else known


def partition_folder(spark: SparkSession, column: str, value: object) -> str:
    """Name of a partition's folder, escaped as the writer does it."""
    text = None if value is None else str(value)
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, text)


def drop_partition(spark: SparkSession, target: str, folder: str) -> bool:
    """Remove one partition folder; true if there was one."""
    root = target.rstrip("/")
    fs, parent = _fs(spark, root)
    # A path made from parent and child is taken as it is, so escapes in the name stay.
    jpath = spark._jvm.org.apache.hadoop.fs.Path(parent, folder)
    return fs.exists(jpath) and fs.delete(jpath, True)


def partition_columns(spark: SparkSession, target: str) -> list[str]:
    """Partition columns of a table, from the names along one chain of its folders."""
    fs, jpath = _fs(spark, target)
    found = []
    while True:
        names = sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory())
        named = [n for n in names if "=" in n]
        if not named:
            return found
        found.append(named[0].split("=", 1)[0])
        jpath = spark._jvm.org.apache.hadoop.fs.Path(jpath, named[0])


def partition_values(spark: SparkSession, target: str, column: str) -> list[str]:
    """Values of a table's first partition column, from the folder names alone."""
    fs, jpath = _fs(spark, target)
    prefix = f"{column}="
    names = (status.getPath().getName() for status in fs.listStatus(jpath))
    return sorted(n[len(prefix):] for n in names if n.startswith(prefix))


def data_files(spark: SparkSession, target: str, folders: Sequence[str] | None = None) -> int:
    """Number of data files below a path, or below some of its partition folders. Counted by the file system, no name is listed here."""
    fs, root = _fs(spark, target)
    path = spark._jvm.org.apache.hadoop.fs.Path
    if folders is not None:
        some = [path(root, f) for f in folders]
        return sum(fs.getContentSummary(p).getFileCount() for p in some if fs.exists(p))
    return fs.getContentSummary(root).getFileCount() - int(fs.exists(path(root, "_SUCCESS")))


def register_external(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Give files at a path a catalog name without moving them."""
    spark.catalog.createTable(name, path=path, source="parquet")
    if any("=" in s.getPath().getName() for s in _fs(spark, path)[0].listStatus(_fs(spark, path)[1])):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)

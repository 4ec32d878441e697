"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.session import scratch_path


# Lets go of the shuffle files of a query when it ends: the table it wrote is what counts from then on.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage and outlives lost executors."""
    spark = df.sparkSession
    path, before = scratch_path(spark, label), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


# Ids that are sent to all tasks rather than having all texts dealt by id: counted first.
SENT_IDS = 2_000_000


def with_ids(rows: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows whose id, NULL included, is one of ``ids`` (a table of one column); none is copied.

    Up to ``SENT_IDS`` ids go to the tasks that scan the rows; more are met by a shuffle.
    """
    wanted = written(ids.distinct().toDF("wanted id"), "wanted-ids")
    side = F.broadcast(wanted) if wanted.count() <= SENT_IDS else wanted
    return rows.join(side, rows[id_col].eqNullSafe(side["wanted id"]), "left_semi")


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for each node of the edges ``a, b``: equal labels where edges connect the nodes.

    In each round every node moves to the node of least random priority within two steps, and edges
    are renamed accordingly, until none is left. Stars vanish in one round and long chains shrink by a
    constant factor, so the number of rounds grows with the logarithm of the longest chain.
    """
    left = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    moves, seed = [], 0
    while not left.isEmpty():
        around = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = around.unionByName(around.select("a", F.col("a").alias("b")).distinct())
        priority = F.struct(F.xxhash64("b", F.lit(seed)).alias("order"), F.col("b").alias("to"))
        one = near.groupBy("a").agg(F.min(priority).alias("best"))
        two = near.join(one.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("best").alias("best"))
        move = written(two.select("a", F.col("best.to").alias("to")), "moves")
        moves.append(move)
        to_a = move.select("a", F.col("to").alias("new_a"))
        to_b = move.select(F.col("a").alias("b"), F.col("to").alias("new_b"))
        renamed = left.join(to_a, "a").join(to_b, "b").select(F.col("new_a").alias("a"), F.col("new_b").alias("b"))
        left = written(renamed.filter("a <> b").distinct(), "edges")
        seed += 1
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = moves[0].select(F.col("a").alias("node"), F.col("to").alias("label"))
    for move in moves[1:]:
        later = move.select(F.col("a").alias("label"), "to")
        labels = labels.join(later, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return written(labels, "labels")

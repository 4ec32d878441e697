"""Write, audit, publish: rules are counted in the very pass that writes the staged table, which goes live only if it may.

The counters are observed metrics. They stand in the task that writes the files, after any shuffle, so a task repeated for a lost
executor is not counted twice; the rows written are compared with them before anything is published.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopstream.operators.quality import PIPELINE_EXPECTATIONS, conjunction, passes
from shopstream.sources import tables

ACTIONS = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Audit:
    """What a write found: all rows, rows written, and failed rows of each rule."""

    rows: int
    written: int
    failed: Mapping[str, int]
    actions: Mapping[str, str]

    @property
    def broken(self) -> list[str]:
        """Rules that forbid publication."""
        return [n for n, k in self.failed.items() if k and self.actions[n] == "fail"]

    def report(self, spark: SparkSession) -> DataFrame:
        """``expectation, action, passed, failed``: one row for each rule."""
        rows = [(n, self.actions[n], self.rows - k, k) for n, k in self.failed.items()]
        return spark.createDataFrame(rows, "expectation string, action string, passed bigint, failed bigint")


class ExpectationsFailed(Exception):
    """Nothing was published; ``audit`` has the counts."""

    def __init__(self, target: str, audit: Audit):
        super().__init__(f"{target} not published: " + ", ".join(f"{n} fails {audit.failed[n]} rows" for n in audit.broken))
        self.audit = audit


def publish(
    df: DataFrame,
    target: str,
    rules: Mapping[str, str] = PIPELINE_EXPECTATIONS,
    action: str | Mapping[str, str] = "drop",
    partition_by: Sequence[str] = (),
    mode: str = "replace",
) -> Audit:
    """Write ``df`` to a path if its rules allow.

    ``action`` is one for all rules or one for each: ``warn`` counts, ``drop`` leaves rows out, ``fail`` forbids publication if any row fails. On
    failure ``ExpectationsFailed`` is raised and the table is as it was. ``mode="replace"`` replaces the table, ``"append"`` adds to it.
    A rule that comes out NULL has failed. The rows are computed once.
    """
    actions = {n: action if isinstance(action, str) else action.get(n, "warn") for n in rules}
    unknown = sorted(set(actions.values()) - set(ACTIONS))
    if unknown or mode not in ("replace", "append"):
        raise ValueError(f"unknown action or mode: {unknown or mode}")
    spark, target = df.sparkSession, target.rstrip("/")
    staged = f"{target}__new_{uuid.uuid4().hex[:8]}"
    names = {f"failed_{i}": n for i, n in enumerate(rules)}
    seen = Observation()
    counters = [F.count_if(~passes(rules[n])).alias(c) for c, n in names.items()]
    placed = tables.balanced(df, partition_by).observe(seen, F.count("*").alias("rows"), *counters)
    dropped = {n: p for n, p in rules.items() if actions[n] == "drop"}
    kept = placed.filter(conjunction(dropped)) if dropped else placed
    kept_seen = Observation()
    kept = kept.observe(kept_seen, F.count("*").alias("rows"))
    writer = kept.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(staged)
        found = seen.get
        audit = Audit(found["rows"], kept_seen.get["rows"], {n: found[c] for c, n in names.items()}, actions)
        if audit.broken:
            raise ExpectationsFailed(target, audit)
        there = spark.read.schema(df.schema).parquet(staged).count()
        if there != audit.written:
            raise RuntimeError(f"{target} not published: {there} rows staged, {audit.written} counted")
        if mode == "replace":
            tables.swap(spark, staged, target)
        else:
            tables.move_files(spark, staged, target)
        spark.catalog.refreshByPath(target)
    finally:
        tables.drop_path(spark, staged)
    return audit

"""Quality classifier: a sparse rule ensemble.

Statistics of a text are computed in one vectorised pass. Small trees over the statistics of a labelled sample
are cut into paths; each path is a conjunction of thresholds, a rule. A lasso logistic regression over the
rules as 0/1 inputs leaves few of them with a weight. The rules that stay are compiled into one Spark
column, so scoring runs inside generated code, and the model can be read as a list of conditions.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from shopstream.llm.arrow import SMALL_BLOCK_BYTES, batch, map_blocks, narrow
from shopstream.llm.words import SPACE, Words, mix, runs, words
from shopstream.session import scratch_path

STATS = (
    "bytes",
    "words",
    "word_bytes",
    "upper_share",
    "digit_share",
    "symbol_share",
    "stop_share",
    "high_share",
    "short_word_share",
    "distinct_word_share",
    "distinct_triple_share",
    "repeated_line_share",
    "line_words",
)


def _bytes(chars: str) -> np.ndarray:
    table = np.zeros(256, np.float32)
    table[list(chars.encode())] = 1
    return table


_UPPER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _bytes("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _bytes("0123456789")
_STOP = _bytes(".,;:'\"-")
_SYMBOL = 1 - _UPPER - _LOWER - _DIGIT - _STOP - SPACE.astype(np.float32)
_SYMBOL[128:] = 0
_HIGH = np.zeros(256, np.float32)
_HIGH[128:] = 1


def distinct(value: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Number of distinct values of each owner."""
    if not len(value):
        return np.zeros(rows)
    order = np.lexsort((value, owner))
    v, o = value[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=rows).astype(float)


def statistics(w: Words) -> np.ndarray:
    """One row for each text, one column for each of ``STATS``; shares of nothing are 0."""
    rows = len(w.text_start) - 1
    size = np.diff(w.text_start).astype(float)
    data, owner = w.data, np.repeat(np.arange(rows), np.diff(w.text_start))

    def count(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[data], dtype=np.float64)])
        return np.diff(sums[w.text_start])

    n_words = np.diff(w.first).astype(float)
    of_word = np.repeat(np.arange(rows), np.diff(w.first))
    length = (w.end - w.start).astype(float)
    sums = np.concatenate([[0], np.cumsum(length)])
    short = np.concatenate([[0], np.cumsum(length <= 3)])
    triples = runs(w.value, 3)
    inside = of_word[: len(triples)] == of_word[2 : 2 + len(triples)]
    n_triples = np.maximum(n_words - 2, 0)
    # Lines: words between line ends, by a sum of their hashes that depends on the order.
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    line_no = breaks[w.start]
    new_line = np.ones(len(line_no), bool)
    new_line[1:] = (line_no[1:] != line_no[:-1]) | (of_word[1:] != of_word[:-1])
    at = np.flatnonzero(new_line)
    within = np.arange(len(line_no)) - np.repeat(at, np.diff(at, append=len(line_no)))
    lines = np.add.reduceat(mix(w.value + within.astype(np.uint64)), at) if len(at) else np.zeros(0, np.uint64)
    n_lines = np.bincount(of_word[at], minlength=rows).astype(float)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.divide(part, whole, out=np.zeros(rows), where=whole > 0)

    upper = count(_UPPER)
    out = np.stack(
        [
            size,
            n_words,
            share(np.diff(sums[w.first]), n_words),
            share(upper, upper + count(_LOWER)),
            share(count(_DIGIT), size),
            share(count(_SYMBOL), size),
            share(count(_STOP), size),
            share(count(_HIGH), size),
            share(np.diff(short[w.first]), n_words),
            share(distinct(w.value, of_word, rows), n_words),
            share(distinct(triples[inside], of_word[: len(triples)][inside], rows), n_triples),
            share(n_lines - distinct(lines, of_word[at], rows), n_lines),
            share(n_words, n_lines),
        ],
        axis=1,
    )
    del owner
    return out


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``STATS`` for each row; a null text counts as empty. No shuffle."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        stats = statistics(words(block.column(1)))
        return batch(["doc_id", *STATS], [block.column(0), *(pa.array(c) for c in stats.T)])

    kind = dict(docs.dtypes)[id_col]
    schema = ", ".join([f"doc_id {kind}", *(f"{s} double" for s in STATS)])
    return map_blocks(narrow(docs, doc_id=id_col, text=text_col), work, schema, SMALL_BLOCK_BYTES)


class Rule(NamedTuple):
    """A conjunction: for each statistic a lower bound (exclusive) and an upper bound (inclusive)."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self, of: Callable[[str], Column] = F.col) -> Column:
        out = F.lit(True)
        for name, low, high in self.bounds:
            if low > -math.inf:
                out = out & (of(name) > F.lit(low))
            if high < math.inf:
                out = out & (of(name) <= F.lit(high))
        return out


class Model(NamedTuple):
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, of: Callable[[str], Column] = F.col) -> Column:
        """Probability of label 1 as a column over the statistics; ``of`` gives the column of a name."""
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(rule.column(of), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


_CONDITION = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([-+0-9.eE]+)\)$")


def tree_rules(description: str) -> list[Rule]:
    """Every path of a described tree, from the root to each node below it, as a rule."""
    found, path = [], []
    for line in description.splitlines():
        hit = _CONDITION.match(line)
        if not hit:
            continue
        depth = len(hit[1])
        path = [step for step in path if step[0] < depth]
        path.append((depth, STATS[int(hit[3])], hit[4], float(hit[5])))
        found.append(simplified([step[1:] for step in path]))
    return found


def simplified(conditions: list[tuple[str, str, float]]) -> Rule:
    bounds: dict[str, tuple[float, float]] = {}
    for name, sign, value in conditions:
        low, high = bounds.get(name, (-math.inf, math.inf))
        bounds[name] = (low, min(high, value)) if sign == "<=" else (max(low, value), high)
    return Rule(tuple((name, *bounds[name]) for name in sorted(bounds)))


def fit(
    labelled: DataFrame,
    label_col: str = "quality",
    trees: int = 12,
    depth: int = 3,
    penalty: float = 0.001,
    seed: int = 7,
) -> Model:
    """Rules and weights from rows with ``STATS`` and a 0/1 label; rows with another or no label are left out.

    Without rows the score is 0.5 everywhere, with one label only that label's share, smoothed.
    """
    rows = labelled.filter(F.col(label_col).isin(0, 1)).select(*STATS, F.col(label_col).cast("double").alias("label"))
    ones, n = rows.agg(F.sum("label"), F.count("*")).first()
    if not n or ones in (0, n):
        share = ((ones or 0) + 1) / (n + 2)
        return Model(math.log(share / (1 - share)), ())
    assembled = VectorAssembler(inputCols=list(STATS), outputCol="features").transform(rows).select("features", "label", *STATS)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, maxBins=64, minInstancesPerNode=5, featureSubsetStrategy="0.5"
    ).fit(assembled)
    rules = sorted({rule for tree in forest.trees for rule in tree_rules(tree.toDebugString)})
    if not rules:
        share = ones / n
        return Model(math.log(share / (1 - share)), ())
    names = [f"rule_{i}" for i in range(len(rules))]
    marked = rows.select("label", *(rule.column().cast("double").alias(name) for rule, name in zip(rules, names)))
    inputs = VectorAssembler(inputCols=names, outputCol="features").transform(marked).select("label", "features")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60).fit(inputs)
    kept = [(rule, float(weight)) for rule, weight in zip(rules, lasso.coefficients.toArray()) if weight]
    return Model(float(lasso.intercept), tuple(kept))


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The statistics as a table in the shared folder: they are read for the fit and for the scores."""
    path = scratch_path(docs.sparkSession, "statistics")
    document_statistics(docs, id_col, text_col).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def fit_on_labels(stats: DataFrame, labels: DataFrame, sample_rows: int = 20_000, label_col: str = "quality") -> Model:
    """Fit on about ``sample_rows`` labelled documents at most, chosen by a hash of the id.

    ``labels`` has ``doc_id`` and the label. The bound is on the fit alone: every document is scored.
    """
    spark = stats.sparkSession
    total = labels.count()
    # The bound depends on the id alone, so it holds back the rows of both sides before they are joined.
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    inside = part < F.lit(math.ceil((1 << 20) * min(1.0, sample_rows / max(total, 1))))
    path = scratch_path(spark, "sample")
    sample = stats.filter(inside).join(labels.filter(inside).select("doc_id", label_col), "doc_id").select(*STATS, label_col)
    sample.repartition(8).write.parquet(path)
    return fit(spark.read.parquet(path), label_col)


def scores(stats: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted`` for each row of the statistics: 1 where the score reaches ``threshold``.

    Ids may be null or repeated. Only expressions, no shuffle.
    """
    return stats.select("doc_id", model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def filtered(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``threshold`` or more. Each row is judged by its own text, whatever its id."""
    at, inputs = docs.columns.index(text_col), "quality statistics"
    kind = pa.struct([(s, pa.float64()) for s in STATS])

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        stats = statistics(words(block.column(at)))
        made = pa.StructArray.from_arrays([pa.array(c) for c in stats.T], fields=list(kind))
        return pa.RecordBatch.from_arrays([*block.columns, made], names=[*block.schema.names, inputs])

    fields = StructType([StructField(s, DoubleType()) for s in STATS])
    judged = map_blocks(docs, work, StructType([*docs.schema.fields, StructField(inputs, fields)]), SMALL_BLOCK_BYTES)
    score = model.score(lambda name: F.col(f"`{inputs}`.{name}"))
    return judged.filter(score >= threshold).drop(inputs)

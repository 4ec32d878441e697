"""Toxicity by maximum-scoring segments of token log-odds, calibrated by extreme-value statistics.

Every term has a log-odds between toxic and other documents under an informative Dirichlet prior, and counts
with the lower bound of that figure: positive where the term is surely toxic, negative else. The maximal segments
of a text (each of its prefixes and suffixes sums to more than zero, and none can be extended) are its toxic passages, found
by one linear scan. Chance segments of other documents follow an extreme-value law, whose two parameters are fitted;
it gives each segment the number of such segments expected by chance, and all segments of a document together a p-value.
The probability of the label is a logistic function of that p-value's logarithm.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.arrow import BLOCK_BYTES, batch, blocks, map_arrow, map_blocks, narrow
from shopstream.llm.graph import written
from shopstream.llm.letters import letter_words
from shopstream.llm.words import Words

# Terms are counted by the first bits of their hash.
BITS = 20
# Scores are whole numbers of this part of a natural logarithm, so that sums are exact.
UNIT = 1024
# Weight of the prior as a share of the counts; standard deviations and margin (a factor of 4.5) taken off, the latter so that a
# text in a language with somewhat more toxic documents does not score by its plain words; least and greatest score of a term.
PRIOR, SURE, MARGIN, LOW, HIGH = 0.1, 2.0, 1.5, -1.0, 8.0
PARTS = 2


class Model(NamedTuple):
    """``terms``: score of each bin. ``rate, size``: a text of n terms has ``size * n * exp(-rate * s)`` chance segments of score s."""

    terms: np.ndarray
    rate: float
    size: float
    offset: float
    slope: float


def bins(w: Words) -> np.ndarray:
    return (w.value >> np.uint64(64 - BITS)).astype(np.int64)


def term_scores(toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Lower bounds of the log-odds of all bins, in units, from the number of documents of each kind that hold them."""
    both = (toxic + other).astype(float)
    n_toxic, n_other = max(int(toxic.sum()), 1), max(int(other.sum()), 1)
    prior = PRIOR * both
    seen = both > 0
    out = np.full(len(both), LOW)
    a, b, p = toxic[seen], other[seen], prior[seen]
    weight = PRIOR * (n_toxic + n_other)
    odds = np.log((a + p) / (n_toxic + weight - a - p)) - np.log((b + p) / (n_other + weight - b - p))
    out[seen] = np.clip(odds - SURE * np.sqrt(1 / (a + p) + 1 / (b + p)) - MARGIN, LOW, HIGH)
    return np.rint(out * UNIT).astype(np.int32)


def maximal(low: list[int], high: list[int]) -> list[tuple[int, int, int]]:
    """Maximal segments as (first run, last run, score).

    Runs are the stretches of positive scores, in order; ``low`` and ``high`` are the sums of all scores before and
    up to the end of each. Linear: a search skips every earlier segment that cannot begin the answer.
    """
    kept: list[tuple[int, int, int, int, int]] = []
    for i, (a, b) in enumerate(zip(low, high)):
        first = i
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= a:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= b:
                kept.append((first, i, a, b, j))
                break
            first, a = kept[j][0], kept[j][2]
            del kept[j:]
    return [(first, last, b - a) for first, last, a, b, _ in kept]


class Segments(NamedTuple):
    """Of each text: number of terms, and its segments as (first term, last term, score in units), terms counted in the block."""

    size: np.ndarray
    found: list[list[tuple[int, int, int]]]


def segments(w: Words, terms: np.ndarray) -> Segments:
    rows = len(w.first) - 1
    score = terms[bins(w)]
    sums = np.concatenate([[0], np.cumsum(score, dtype=np.int64)])
    positive = score > 0
    edge = np.zeros(len(score) + 1, bool)
    edge[w.first] = True
    begins, ends = positive.copy(), positive.copy()
    begins[1:] &= ~positive[:-1] | edge[1:-1]
    ends[:-1] &= ~positive[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    low, high = sums[start].tolist(), sums[end + 1].tolist()
    first = np.searchsorted(start, w.first).tolist()
    start, end = start.tolist(), end.tolist()
    found = []
    for a, b in zip(first[:-1], first[1:]):
        found.append([(start[a + i], end[a + j], s) for i, j, s in maximal(low[a:b], high[a:b])] if b > a else [])
    return Segments(np.diff(w.first), found) if rows else Segments(np.zeros(0, np.int64), [])


def fit_chance(size: np.ndarray, best: np.ndarray) -> tuple[float, float]:
    """(rate, size) of the extreme-value law of the best scores of texts with ``size`` terms; 0 stands for none found."""
    size, best = size[size > 0].astype(float), best[size > 0] / UNIT
    some = best > 0
    if some.sum() < 2:
        return 1.0, 1.0 / max(size.sum(), 1.0)

    def share(rate):
        return some.sum() / (size * np.exp(-rate * best)).sum()

    def likelihood(rate):
        k = share(rate)
        return some.sum() * math.log(rate * k) - rate * best[some].sum() - k * (size * np.exp(-rate * best)).sum()

    low, high = 1e-3, 20.0
    golden = (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - golden * (high - low), low + golden * (high - low)
        if likelihood(a) < likelihood(b):
            low = a
        else:
            high = b
    rate = (low + high) / 2
    return rate, share(rate)


def evidence(size: int, scores: list[int], rate: float, chance: float) -> float:
    """Negative logarithm of the chance that a text of ``size`` terms has such segments: the best over the r highest, for all r."""
    if not scores or not size:
        return 0.0
    each = math.log(chance * size)
    best = total = 0.0
    for r, s in enumerate(sorted(scores, reverse=True), 1):
        total += rate * s / UNIT - each
        if total <= r:
            continue
        # Sum statistics of r segments; r * ln 2 pays for having tried several r.
        value = total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r) - r * math.log(2)
        best = max(best, value)
    return best


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(offset, slope) of the probability of label 1, a little pulled to zero, slope never negative."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = math.log(share / (1 - share))
    if not len(y) or y.min() == y.max():
        return base, 0.0
    a, b = base, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        v = p * (1 - p)
        gradient = np.array([(y - p).sum(), ((y - p) * x).sum() - 0.1 * b])
        h = np.array([[v.sum() + 1e-9, (v * x).sum()], [(v * x).sum(), (v * x * x).sum() + 0.1]])
        step = np.linalg.solve(h, gradient)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return (float(a), float(b)) if b > 0 else (base, 0.0)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, sample_rows: int, id_col: str, text_col: str, label_col: str
) -> DataFrame:
    """``text, label, part`` of about ``sample_rows`` labelled documents at most, chosen by a hash of the id.

    An id with both labels, another label than 0 and 1, or no document is left out; of the texts of a repeated id the least is taken.
    """
    spark = docs.sparkSession
    known = (
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .select("id", F.col("label").cast("int").alias("label"))
    )
    known = written(known, "toxic-labels")
    share = min(1.0, sample_rows / max(known.count(), 1))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    chosen = F.broadcast(known.filter(place < F.lit(math.ceil((1 << 20) * share))))  # about sample_rows rows, by the share
    texts = narrow(docs, id=id_col, text=text_col).join(chosen, "id")
    texts = texts.groupBy("id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(PARTS)).cast("int")
    return written(texts.select("text", "label", part.alias("part")), "toxic-sample")


def term_counts(sample: DataFrame) -> np.ndarray:
    """Number of documents with each bin, as an array of parts by labels by bins. Counts are combined in the task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(PARTS * 2 << BITS, np.int64)
        for some in batches:
            for block in blocks(some, BLOCK_BYTES):
                w = letter_words(block.column(0))
                kind = 2 * np.asarray(block.column(2)).astype(np.int64) + np.asarray(block.column(1))
                owner = np.repeat(np.arange(block.num_rows), np.diff(w.first))
                seen = np.unique(owner << BITS | bins(w))
                np.add.at(held, kind[seen >> BITS] << BITS | (seen & (1 << BITS) - 1), 1)
        cells = np.flatnonzero(held)
        yield batch(["cell", "n"], [pa.array(cells), pa.array(held[cells])])

    counted = map_arrow(sample, run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # at most PARTS * 2 * 2^BITS rows, whatever the input
    out = np.zeros(PARTS * 2 << BITS, np.int64)
    out[found["cell"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(PARTS, 2, 1 << BITS)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Learn from about ``sample_rows`` labelled documents at most.

    The laws of chance and of the label are fitted on scores that each half of the sample gets from the other half's terms.
    Without labels of both kinds no text has a segment, and every score is the label's share, smoothed.
    """
    sample = labelled_sample(docs, labels, sample_rows, id_col, text_col, label_col)
    counts = term_counts(sample)
    halves = [term_scores(counts[1 - p][1], counts[1 - p][0]) for p in range(PARTS)]
    shared = sample.sparkSession.sparkContext.broadcast(halves)

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        w = letter_words(block.column(0))
        part = np.asarray(block.column(2))
        sides = [segments(w, terms) for terms in shared.value]
        found = [[s for *_, s in sides[p].found[i]] for i, p in enumerate(part.tolist())]
        return batch(["label", "size", "scores"], [block.column(1), pa.array(sides[0].size), pa.array(found, pa.list_(pa.int64()))])

    scored = written(map_blocks(sample, work, "label int, size bigint, scores array<bigint>"), "toxic-segments")
    best = F.coalesce(F.array_max("scores"), F.lit(0)).alias("best")
    clean = scored.filter("label = 0").select("size", best).toArrow()  # of the sample: bounded
    rate, chance = fit_chance(clean["size"].to_numpy(), clean["best"].to_numpy())

    def judge(block: pa.RecordBatch) -> pa.RecordBatch:
        found = zip(block.column(1).to_pylist(), block.column(2).to_pylist())
        return batch(["label", "x"], [block.column(0), pa.array([evidence(n, s, rate, chance) for n, s in found], pa.float64())])

    known = map_blocks(scored, judge, "label int, x double").toArrow()
    order = np.lexsort((known["label"].to_numpy(), known["x"].to_numpy()))
    offset, slope = logistic(known["x"].to_numpy()[order], known["label"].to_numpy()[order].astype(float))
    shared.unpersist()
    return Model(term_scores(counts[:, 1].sum(0), counts[:, 0].sum(0)), rate, chance, offset, slope)


def scores(
    docs: DataFrame,
    model: Model,
    threshold: float = 0.3,
    expected: float = 0.01,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, score, predicted, passages`` for each row of ``docs``. No shuffle.

    ``score`` is the probability of label 1, ``predicted`` 1 where it reaches ``threshold``. ``passages`` lists every maximal segment of which
    no more than ``expected`` such are to be expected by chance in a text of that length: ``start`` and ``end`` in code points (end
    exclusive), ``score`` in natural logarithms, ``expected``; in order of place.

    A null or empty text, and one without letters, has no passage and the lowest score. Very long texts are scanned whole, in time
    linear in their length. Repeated rows are judged each, alike; a null id stays null; other columns are ignored, whatever their names;
    an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.terms)  # 2^BITS numbers
    rate, chance, offset, slope = model[1:]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        w = letter_words(block.column(1))
        size, found = segments(w, shared.value)
        points = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
        score, passages = [], []
        for i, (n, some) in enumerate(zip(size.tolist(), found)):
            x = evidence(n, [s for *_, s in some], rate, chance)
            score.append(1 / (1 + math.exp(-max(-700.0, min(700.0, offset + slope * x)))))
            base, rare = points[w.text_start[i]], []
            for a, b, s in some:
                e = chance * n * math.exp(-rate * s / UNIT)
                if e <= expected:
                    at = int(points[w.start[a]] - base), int(points[w.end[b]] - base)
                    rare.append({"start": at[0], "end": at[1], "score": s / UNIT, "expected": e})
            passages.append(rare)
        return batch(["doc_id", "score", "passages"], [block.column(0), pa.array(score, pa.float64()), pa.array(passages, kind)])

    id_kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {id_kind}, score double, passages array<struct<start:bigint,end:bigint,score:double,expected:double>>"
    judged = map_blocks(narrow(docs, doc_id=id_col, text=text_col), work, schema)
    return judged.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")

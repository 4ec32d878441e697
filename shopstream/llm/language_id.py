"""Language identification by multilingual mixture inference.

A document is a mixture of languages. Each language gives its byte trigrams (hashed to a fixed number
of bins) a likelihood, learned from the labelled documents; expectation-maximisation finds the
proportions of the mixture that explain a document best. Of the nested sets of its strongest languages, the one with
the best likelihood after a penalty for each further language is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.arrow import BLOCK_BYTES, batch, blocks, map_arrow, map_blocks, narrow
from shopstream.llm.words import raw

BITS = 15
BINS = 1 << BITS
# Languages whose counts a task holds at once before it hands them on.
HELD = 64
SMOOTHING = 0.5
ROUNDS = 8
PENALTY = 2.0
MAX_LANGUAGES = 1024

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each trigram, text of each trigram); a text has a space put before and behind it."""
    data, start = raw(column)
    rows = len(column)
    size = np.diff(start)
    at = start[:-1] + 2 * np.arange(rows) + 1
    padded = np.full(len(data) + 2 * rows, 32, np.uint32)
    owner = np.repeat(np.arange(rows, dtype=np.int64), size + 2)
    padded[np.arange(len(data)) + np.repeat(at - start[:-1], size)] = _LOWER[data]
    if len(padded) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = padded[:-2] << np.uint32(16) | padded[1:-1] << np.uint32(8) | padded[2:]
    inside = owner[:-2] == owner[2:]
    bins = (code[inside] * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    return bins.astype(np.int64), owner[:-2][inside]


def trigram_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, bin, n`` over all documents that have a language and a text. Counts are combined in the task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def release():
            for lang, counts in held.items():
                bins = np.flatnonzero(counts)
                yield batch(
                    ["lang", "bin", "n"],
                    [pa.array([lang] * len(bins), pa.string()), pa.array(bins, pa.int32()), pa.array(counts[bins], pa.int64())],
                )
            held.clear()

        for some in batches:
            for block in blocks(some, BLOCK_BYTES):
                codes = block.column(0).dictionary_encode()
                bins, owner = trigrams(block.column(1))
                names = codes.dictionary.to_pylist()
                of_row = np.asarray(codes.indices)
                if len(held) + len(names) > HELD:
                    yield from release()
                counts = np.bincount(of_row[owner] * BINS + bins, minlength=len(names) * BINS).reshape(len(names), BINS)
                for name, row in zip(names, counts):
                    held[name] = held[name] + row if name in held else row
        yield from release()

    rows = narrow(docs, lang=lang_col, text=text_col).dropna()
    counted = map_arrow(rows, run, "lang string, bin int, n bigint")
    return counted.groupBy("lang", "bin").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """(languages, likelihood of each bin in each language as an array of bins by languages).

    The model has ``BINS`` numbers for each language whatever the input; more than ``MAX_LANGUAGES`` is an error.
    """
    counted = trigram_counts(docs, lang_col, text_col)
    found = counted.toArrow()
    langs = sorted(set(found["lang"].to_pylist()))
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"{len(langs)} languages; at most {MAX_LANGUAGES} are supported")
    counts = np.zeros((BINS, len(langs)))
    if langs:
        column = np.searchsorted(np.array(langs, object), np.array(found["lang"].to_pylist(), object))
        counts[found["bin"].to_numpy(), column] = found["n"].to_numpy()
    counts += SMOOTHING
    return langs, (counts / counts.sum(0)).astype(np.float32)


class Mixture:
    """The distinct trigrams of a block of texts with their likelihoods."""

    def __init__(self, bins: np.ndarray, owner: np.ndarray, likelihood: np.ndarray):
        keys, self.n = np.unique((owner << BITS | bins).astype(np.uint32 if (owner.max() >> (32 - BITS)) == 0 else np.int64), return_counts=True)
        keys = keys.astype(np.int64)
        self.likelihood = likelihood[keys & (BINS - 1)]
        owner = keys >> BITS
        self.first = np.flatnonzero(np.diff(owner, prepend=-1))
        self.texts = owner[self.first]
        self.size = np.diff(self.first, append=len(owner))
        self.n = self.n.astype(np.float32)
        self.total = np.add.reduceat(self.n, self.first)

    def shares(self, start: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """(proportions, log-likelihood) of each text after some rounds of expectation-maximisation.

        A language with no share at the start has none at the end.
        """
        share = start
        for _ in range(rounds):
            parts = np.repeat(share, self.size, axis=0) * self.likelihood
            parts *= (self.n / parts.sum(1))[:, None]
            share = np.add.reduceat(parts, self.first, axis=0) / self.total[:, None]
        whole = (np.repeat(share, self.size, axis=0) * self.likelihood).sum(1)
        return share, np.add.reduceat(self.n * np.log(whole), self.first)

    def only(self, keep: np.ndarray) -> Mixture:
        """The same for some of the texts."""
        some = object.__new__(Mixture)
        rows = np.repeat(keep, self.size)
        some.likelihood, some.n = self.likelihood[rows], self.n[rows]
        some.size, some.texts, some.total = self.size[keep], self.texts[keep], self.total[keep]
        some.first = np.cumsum(some.size) - some.size
        return some


def infer(mixture: Mixture, languages: int) -> np.ndarray:
    """Proportions of each text over the set of languages with the best penalised likelihood."""
    texts = len(mixture.first)
    full, _ = mixture.shares(np.full((texts, languages), 1 / languages, np.float32), ROUNDS)
    order = np.argsort(-full, axis=1, kind="stable")
    best = np.zeros_like(full)
    best[np.arange(texts), order[:, 0]] = 1
    _, score = mixture.shares(best, 0)
    going, some = np.arange(texts), mixture
    for size in range(2, languages + 1):
        start = np.zeros((len(going), languages), np.float32)
        picked = order[going, :size]
        rows = np.arange(len(going))[:, None]
        # Never from zero, or a language could not come back.
        start[rows, picked] = np.maximum(full[going[:, None], picked], 1e-3)
        start /= start.sum(1, keepdims=True)
        share, fitted = some.shares(start, ROUNDS // 2)
        better = fitted - PENALTY * np.log(some.total + 1) > score[going]
        best[going[better]] = share[better]
        score[going[better]] = (fitted - PENALTY * np.log(some.total + 1))[better]
        if not better.any():
            break
        going, some = going[better], some.only(better)
    return best


def identify(
    docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score, languages`` for each row of ``docs``.

    ``languages`` lists the set kept with each one's share, the largest first (ties by name);
    ``lang_pred`` is the first of it and ``score`` its share. A text that is null or has no letter, or any text if
    the model has no language, gets ``und``, 0 and an empty list. Repeated rows are judged each; a
    null id stays null; other columns are ignored. Only ``fit`` shuffles.
    """
    langs, likelihood = model
    shared = docs.sparkSession.sparkContext.broadcast(likelihood)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        column = block.column(1)
        pred, score, sets = ["und"] * len(column), [0.0] * len(column), [[] for _ in range(len(column))]
        lettered = np.array([any(map(str.isalpha, t or "")) for t in column.to_pylist()], bool)
        if langs and lettered.any():
            rows = np.flatnonzero(lettered)
            bins, owner = trigrams(column.take(pa.array(rows)))
            mixture = Mixture(bins, owner, shared.value)
            best = infer(mixture, len(langs))
            for row, share in zip(rows[mixture.texts].tolist(), best.tolist()):
                kept = sorted(((-p, lang) for p, lang in zip(share, langs) if p > 0))
                pred[row], score[row] = kept[0][1], min(1.0, -kept[0][0])
                sets[row] = [{"lang": lang, "share": -p} for p, lang in kept]
        return batch(
            ["doc_id", "lang_pred", "score", "languages"],
            [block.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(sets, kind)],
        )

    id_kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {id_kind}, lang_pred string, score double, languages array<struct<lang:string,share:double>>"
    return map_blocks(narrow(docs, doc_id=id_col, text=text_col), work, schema)

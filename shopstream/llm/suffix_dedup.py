"""Repeated passages by a sparse suffix array.

Of the suffixes of all documents only those are kept that start at a minimiser: the least hash of ``k`` words
among ``w`` consecutive ones. Where two documents share ``k + w - 1 = least`` words, they choose the same
place in them. The kept suffixes are sorted by fingerprints of their first ``k`` words and of the words up
to ``least``, so those with a long common beginning are neighbours. Each is compared with the one before it;
if the first ``k`` words are equal, the two documents are laid side by side at that shift and
every common run is extended left and right as far as it goes.

A suffix may share ``k`` words with its neighbours and ``least`` with one further away. So where three or more
suffixes begin alike, and the runs found so far do not hold all words of the windows that chose one of them, the windows
of ``least`` words that chose any of them are compared by their hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstream.llm.arrow import batch, map_arrow, map_blocks, narrow
from shopstream.llm.graph import with_ids, written
from shopstream.llm.words import Words, long_runs, mix, words

LEAST = 50
SPANS = "array<struct<start:int,end:int>>"


def window(least: int) -> tuple[int, int]:
    """(k, w) with ``k + w - 1 = least``: about two thirds of the words are compared by fingerprint."""
    k = max(1, least * 13 // 20)
    return k, least - k + 1


def minimisers(w: Words, least: int) -> tuple[np.ndarray, ...]:
    """(text, place in words, first and last start of the windows that chose it, fingerprint of the first words, of the
    rest up to ``least``) of each kept suffix. The windows that choose a place follow each other.

    All places of a text are kept, also those that begin alike: each may go on like another document.
    """
    k, width = window(least)
    every = long_runs(w.value, k)
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    start = np.arange(max(0, len(w.value) - least + 1))
    start = start[text[start] == text[start + least - 1]]
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none
    views = np.lib.stride_tricks.sliding_window_view(every, width)
    chosen = start + views[start].argmin(1)  # rises with the start
    new = np.flatnonzero(np.diff(chosen, prepend=-1))
    at, first, last = chosen[new], start[new], start[np.append(new[1:], len(start)) - 1]
    rest = long_runs(w.value, least - k)
    tail = np.zeros(len(at), np.uint64)
    fits = at + least <= w.first[text[at] + 1]
    tail[fits] = rest[at[fits] + k]
    head = every[at]
    begin = w.first[text[at]]
    return text[at], at - begin, first - begin, last - begin, head.view(np.int64), tail.view(np.int64)


def sequences(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """128 hash bits of the word sequence of each text."""
    place = np.arange(len(w.value)) - np.repeat(w.first[:-1], np.diff(w.first))
    out = []
    for salt in (0x1B873593, 0x85EBCA6B):
        each = mix(w.value ^ mix(place.astype(np.uint64) * np.uint64(2) + np.uint64(salt)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each, dtype=np.uint64)])
        out.append(np.diff(sums[w.first]).view(np.int64))
    return out[0], out[1]


def features(docs: DataFrame, least: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n_words, seq_a, seq_b, suffixes`` of each row."""
    places = ["place", "first", "last"]
    kind = pa.list_(pa.struct([("head", pa.int64()), ("tail", pa.int64()), *((c, pa.int32()) for c in places)]))

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        w = words(block.column(1))
        text, place, first, last, head, tail = minimisers(w, least)
        values = pa.StructArray.from_arrays(
            [*(pa.array(v, pa.int64()) for v in (head, tail)), *(pa.array(v, pa.int32()) for v in (place, first, last))],
            names=["head", "tail", *places],
        )
        offsets = np.searchsorted(text, np.arange(block.num_rows + 1)).astype(np.int32)
        a, b = sequences(w)
        return batch(
            ["doc_id", "n_words", "seq_a", "seq_b", "suffixes"],
            [block.column(0), pa.array(np.diff(w.first), pa.int64()), pa.array(a), pa.array(b), pa.ListArray.from_arrays(offsets, values).cast(kind)],
        )

    id_kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {id_kind}, n_words bigint, seq_a bigint, seq_b bigint, suffixes array<struct<head:bigint,tail:bigint,place:int,first:int,last:int>>"
    return map_blocks(narrow(docs, doc_id=id_col, text=text_col), work, schema)


SUFFIX = ["node", "place", "first", "last"]
NEIGHBOURS = (
    "edge boolean, head bigint, tail bigint, a bigint, place_a int, first_a int, last_a int, b bigint, place_b int, first_b int, last_b int"
)


def neighbours(suffixes: DataFrame) -> DataFrame:
    """Each suffix with the one before it in sorted order, where their first words are equal.

    The order is spread over all tasks by range, hot beginnings too, as the whole key counts; both may be of one
    node. The first and last suffix of a task come out as ``edge`` rows, so that neighbours in two tasks can still meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for some in batches:
            if not some.num_rows:
                continue
            columns = [some.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            begins = last is None
            if not begins:
                columns = [np.concatenate([[v], c]) for v, c in zip(last, columns)]
            head, tail, *suffix = columns
            same = np.flatnonzero(head[1:] == head[:-1]) + 1
            yield neighbour_rows(False, head[same], tail[same], [v[same - 1] for v in suffix], [v[same] for v in suffix])
            if begins:
                yield neighbour_rows(True, head[:1], tail[:1], [v[:1] for v in suffix], [v[:1] for v in suffix])
            last = [c[-1] for c in columns]
        if last is not None:
            head, tail, *suffix = (np.array([v]) for v in last)
            yield neighbour_rows(True, head, tail, suffix, suffix)

    ordered = suffixes.select("head", "tail", *SUFFIX).repartitionByRange("head", "tail", "node", "place")
    return map_arrow(ordered.sortWithinPartitions("head", "tail", "node", "place"), run, NEIGHBOURS)


def neighbour_rows(edge: bool, head: np.ndarray, tail: np.ndarray, a: list, b: list) -> pa.RecordBatch:
    sides = [v.astype(np.int32) if i else v.astype(np.int64) for side in (a, b) for i, v in enumerate(side)]
    names = [c if c != "node" else "" for c in SUFFIX]
    return batch(
        ["edge", "head", "tail", *(f"{c}_{side}".lstrip("_") for side in "ab" for c in names)],
        [pa.array(np.full(len(head), edge)), *(pa.array(v.astype(np.int64)) for v in (head, tail)), *map(pa.array, sides)],
    )


def common_runs(a: np.ndarray, b: np.ndarray, shift: int, least: int) -> list[tuple[int, int]]:
    """(start, end) in ``a`` of the longest runs equal to ``b`` at this shift (place in a less place in b)."""
    low, high = max(0, shift), min(len(a), len(b) + shift)
    if high - low < least:
        return []
    breaks = np.concatenate([[low - 1], low + np.flatnonzero(a[low:high] != b[low - shift : high - shift]), [high]])
    long = np.flatnonzero(np.diff(breaks) > least)
    return [(int(breaks[i]) + 1, int(breaks[i + 1])) for i in long]


def extend(pairs: DataFrame, least: int) -> DataFrame:
    """``node, start, end`` of both sides of each common run. ``pairs`` has ``a, b, text_a, text_b, shifts``."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch | None:
        of_a, of_b = words(block.column(2)), words(block.column(3))
        rows = []
        for i, (a, b, shifts) in enumerate(zip(*(block.column(c).to_pylist() for c in (0, 1, 4)))):
            value_a = of_a.value[of_a.first[i] : of_a.first[i + 1]]
            value_b = of_b.value[of_b.first[i] : of_b.first[i + 1]]
            for shift in shifts:
                for start, end in common_runs(value_a, value_b, shift, least):
                    rows += [(a, start, end), (b, start - shift, end - shift)]
        if not rows:
            return None
        node, start, end = zip(*rows)
        return batch(["node", "start", "end"], [pa.array(node, pa.int64()), pa.array(start, pa.int32()), pa.array(end, pa.int32())])

    return map_blocks(pairs.select("a", "b", "text_a", "text_b", "shifts"), work, "node bigint, start int, end int")


def around(members: DataFrame, aligned: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """``node, start, end`` of runs of ``least`` words that the alignment of neighbours has missed.

    ``members`` has the suffixes with equals, and in ``n`` how many begin alike. Two have been aligned with each other.
    Of more, those are done whose windows lie in aligned runs with all their words; for the others, the windows of
    all suffixes with the same head are compared.
    """
    inside = F.exists("spans", lambda s: (s["start"] <= F.col("first")) & (s["end"] >= F.col("last") + least))
    missing = (
        members.filter("n > 2").join(aligned, "node", "left").filter(~F.coalesce(inside, F.lit(False)))
        .select("head", "node", "first", "last")
    )
    missing = written(missing, "suffix_missing")
    asked = members.join(written(missing.select("head").distinct(), "suffix_asked"), "head")

    def windows_of(rows: DataFrame) -> DataFrame:
        chosen = rows.groupBy("node").agg(F.collect_set(F.struct("first", "last")).alias("chosen"))
        return chosen.join(texts, "node").select("node", "text", "chosen")

    def hashes(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, node, start and row in the block of each window."""
        w = words(block.column(1))
        every = long_runs(w.value, least)
        chosen = block.column(2)
        row = np.repeat(np.arange(block.num_rows), np.diff(chosen.offsets.to_numpy()))
        first, last = (chosen.flatten().field(c).to_numpy().astype(np.int64) for c in ("first", "last"))
        count = last - first + 1
        start = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        row = np.repeat(row, count)
        return every[w.first[row] + start].view(np.int64), block.column(0).to_numpy()[row], start, row

    def holders(block: pa.RecordBatch) -> pa.RecordBatch:
        """Least and greatest node of each run of words: equal runs of a block are one row."""
        value, node, *_ = hashes(block)
        order = np.lexsort((node, value))
        value, node = value[order], node[order]
        first = np.flatnonzero(np.diff(value, prepend=value[:1] - 1)) if len(value) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(value))[: len(first)] - 1
        return batch(["value", "low", "high"], [pa.array(value[first]), pa.array(node[first]), pa.array(node[last])])

    def open_places(block: pa.RecordBatch) -> pa.RecordBatch:
        """Windows with words outside the aligned runs."""
        value, node, start, row = hashes(block)
        bounds = np.searchsorted(row, np.arange(block.num_rows + 1))
        left = np.ones(len(start), bool)
        for low, high, spans in zip(bounds[:-1], bounds[1:], block.column(3).to_pylist()):
            if spans:
                begin, end = (np.array([s[c] for s in spans]) for c in ("start", "end"))
                at = np.searchsorted(begin, start[low:high], "right") - 1
                left[low:high] = (at < 0) | (end[at] < start[low:high] + least)
        return batch(["value", "node", "start"], [pa.array(value[left]), pa.array(node[left]), pa.array(start[left].astype(np.int32))])

    held = map_blocks(windows_of(asked), holders, "value bigint, low bigint, high bigint")
    shared = held.groupBy("value").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high")
    own = map_blocks(windows_of(missing).join(aligned, "node", "left"), open_places, "value bigint, node bigint, start int")
    return own.join(shared.select("value"), "value").select("node", "start", (F.col("start") + least).alias("end"))


def merged(spans: DataFrame) -> DataFrame:
    """``node, spans``: the union of each node's spans, as spans apart from each other, in order."""
    order = Window.partitionBy("node").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    number = F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        spans.distinct()
        .withColumn("new", F.when(F.col("start") <= before, 0).otherwise(1))
        .withColumn("number", number)
        .groupBy("node", "number").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    )


def repeated_passages(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_repeated, spans`` for each row with a passage of ``least`` words that another row has too.

    Words stand between ASCII white space, A-Z lower-cased; ``spans`` are half-open word ranges, merged where they
    touch, and ``n_repeated`` their words. All holders of a passage come out, the first one too. Rows with
    equal word sequences are copies of each other: the whole is their span (from ``least`` words up). Repeats inside one
    document do not count, but a passage that another row has too counts at each place where it stands. A null or
    shorter text has no row; rows with a null id take part and come out with it; other columns are ignored; an empty
    table gives an empty result. No group is capped. Exact up to collisions of
    64-bit hashes.
    """
    made = written(features(docs, least, id_col, text_col), "suffix_features")
    key = ["seq_a", "seq_b", "n_words"]
    long = made.filter(F.col("n_words") >= least)
    nodes = written(
        long.groupBy(*key).agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id()),
        "suffix_nodes",
    )
    # One row of each sequence gives its suffixes; the id in the key spreads groups of copies.
    owners = long.select(*key, F.col("doc_id").alias("least"), "suffixes")
    same = F.col("o.least").eqNullSafe(F.col("n.least"))
    for column in key:
        same = same & (F.col(f"o.{column}") == F.col(f"n.{column}"))
    owned = owners.alias("o").join(nodes.alias("n"), same).select("n.node", "suffixes")
    suffixes = owned.select("node", F.explode("suffixes").alias("s")).select("node", "s.*").distinct()
    met = written(neighbours(written(suffixes, "suffixes")), "neighbours")
    # Ends of tasks: two rows for each task, compared with the one before in the same order.
    order = Window.partitionBy("head").orderBy("tail", "b", "place_b")
    side_a, side_b = (["head", side, *(f"{c}_{side}" for c in SUFFIX[1:])] for side in "ab")
    ends = (
        met.filter("edge").select(*side_b, "tail").distinct()
        .withColumns({a: F.lag(b).over(order) for a, b in zip(side_a[1:], side_b[1:])})
        .filter("a IS NOT NULL")
    )
    both = [*side_a, *side_b[1:]]
    equal = met.filter("NOT edge").select(*both).unionByName(ends.select(*both))
    alike = written(
        equal.select(*side_a).union(equal.select(*side_b)).toDF("head", *SUFFIX).distinct(),
        "suffix_alike",
    )
    # Of suffixes that begin alike those count whose beginning two nodes have. The table of beginnings is written, so
    # that a hot one is split in the join.
    shared = written(
        alike.groupBy("head").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n"))
        .filter("low < high").select("head", "n"),
        "suffix_heads",
    )
    members = alike.join(shared, "head")
    pairs = (
        equal.filter("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                F.when(F.col("a") < F.col("b"), F.col("place_a") - F.col("place_b")).otherwise(F.col("place_b") - F.col("place_a")).alias("shift"))
        .groupBy("a", "b").agg(F.collect_set("shift").alias("shifts"))
    )
    pairs = written(pairs, "suffix_pairs")
    involved = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(nodes.select("node", *key, "least"), "node")
    texts = written(node_texts(docs, involved, id_col, text_col), "suffix_texts")
    sides = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )
    aligned = written(merged(extend(sides, least)), "suffix_runs")
    further = around(members, aligned, texts, least)
    found = merged(aligned.select("node", F.explode("spans").alias("s")).select("node", "s.start", "s.end").union(further))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"))).cast(SPANS)
    of_node = nodes.join(found, "node", "left").select(
        *key, F.when(F.col("copies") > 1, whole).otherwise(F.col("spans").cast(SPANS)).alias("spans")
    )
    return (
        long.select("doc_id", *key).join(of_node.filter("spans IS NOT NULL"), key)
        .select(
            "doc_id", "n_words",
            F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long").alias("n_repeated"),
            "spans",
        )
    )


def node_texts(docs: DataFrame, involved: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``node, text``, one row for each sequence, from rows that have it.

    Rows are chosen by id first, which copies none, then by their own sequence: any number of rows and of sequences may have one id.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col)
    rows = with_ids(rows, "doc_id", involved.select("least")).select("text")

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        w = words(block.column(0))
        a, b = sequences(w)
        return batch(["seq_a", "seq_b", "n_words", "text"], [pa.array(a), pa.array(b), pa.array(np.diff(w.first)), block.column(0)])

    key = ["seq_a", "seq_b", "n_words"]
    found = map_blocks(rows, work, "seq_a bigint, seq_b bigint, n_words bigint, text string").dropDuplicates(key)
    return found.join(involved.select("node", *key), key).select("node", "text")

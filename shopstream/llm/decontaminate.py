"""Benchmark decontamination by greedy string tiling.

Documents are searched for the items of a benchmark. A run of ``least`` words shared by a document and an item is a
seed. Items whose seeds could cover enough of them are tiled: the longest run of words that the two
share, and that no tile holds yet, becomes a tile, again and again, until no run of ``least`` words is
left. Tiles may stand in any order, so a reordered passage is covered as well as a verbatim one. Runs
are compared by Karp-Rabin hashes, and the longest length is found by bisection, as every part of a shared run
is shared too. A document is contaminated by an item if tiles cover a given share of its words, or if one tile has a given
number of words. Items shorter than a seed count where a document has them whole.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.arrow import batch, map_blocks, narrow
from shopstream.llm.words import Words, long_runs, runs, words

LEAST = 5
COVERAGE = 0.5
# Words of one tile that are enough, however long the item.
LONG = 50
# Bytes of benchmark text searched for in one pass over the documents, about.
PASS_BYTES = 16 << 20
FILTER_BITS = 22
TILES = "array<struct<item_start:int,doc_start:int,words:int>>"
TILE_TYPE = pa.list_(pa.struct([("item_start", pa.int32()), ("doc_start", pa.int32()), ("words", pa.int32())]))


class Index(NamedTuple):
    """Seeds of benchmark items: sorted hashes with the item and place of each; ``short`` has, by number of words, the sorted
    hashes and numbers of the items without a seed."""

    ids: list
    first: np.ndarray
    value: np.ndarray
    seed: np.ndarray
    item: np.ndarray
    place: np.ndarray
    maybe: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]


def index(ids: list, texts: list[str | None], least: int) -> Index:
    w = words(pc.utf8_lower(pa.array(texts, pa.string())))
    every = runs(w.value, least)
    item = np.repeat(np.arange(len(ids)), np.diff(w.first))
    at = np.arange(len(every))
    at = at[item[at] == item[at + least - 1]] if len(at) else at
    seed, item, place = every[at], item[at], at - w.first[item[at]]
    order = np.argsort(seed, kind="stable")
    maybe = np.zeros(1 << FILTER_BITS, bool)
    maybe[seed >> np.uint64(64 - FILTER_BITS)] = True
    size, short = np.diff(w.first), {}
    for n in range(1, least):
        few = np.flatnonzero(size == n)
        if len(few):
            whole = runs(w.value, n)[w.first[few]]
            by_hash = np.argsort(whole, kind="stable")
            short[n] = (whole[by_hash], few[by_hash])
    return Index(ids, w.first, w.value, seed[order], item[order], place[order], maybe, short)


def shared_length(a: np.ndarray, free_a: np.ndarray, b: np.ndarray, free_b: np.ndarray, length: int):
    """Hashes and places of the free runs of a length in both sequences that occur in the other."""
    out = []
    for value, free in ((a, free_a), (b, free_b)):
        taken = np.concatenate([[0], np.cumsum(~free)])
        at = np.flatnonzero(taken[length:] == taken[:-length])
        out.append((long_runs(value, length)[at], at))
    (hash_a, at_a), (hash_b, at_b) = out
    keep_a, keep_b = np.isin(hash_a, hash_b), np.isin(hash_b, hash_a)
    return hash_a[keep_a], at_a[keep_a], hash_b[keep_b], at_b[keep_b]


def tiling(item: np.ndarray, doc: np.ndarray, usable: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(place in the item, place in the document, words) of each tile, the longest first.

    Among equally long runs the one that starts first in the item, then first in the document, is marked first.
    """
    free_item, free_doc = np.ones(len(item), bool), usable.copy()
    tiles, high = [], min(len(item), len(doc))
    while high >= least:
        low, best = least, None
        while low <= high:  # the longest length that still has a shared free run
            length = (low + high) // 2
            found = shared_length(item, free_item, doc, free_doc, length)
            if len(found[0]):
                best, low = (length, found), length + 1
            else:
                high = length - 1
        if best is None:
            break
        length, (hash_a, at_a, hash_b, at_b) = best
        places: dict[int, list[int]] = {}
        for h, place in zip(hash_b.tolist(), at_b.tolist()):
            places.setdefault(h, []).append(place)
        next_of = dict.fromkeys(places, 0)
        for h, i in zip(hash_a.tolist(), at_a.tolist()):
            if not free_item[i : i + length].all():
                continue
            some = places[h]
            while next_of[h] < len(some):
                j = some[next_of[h]]
                next_of[h] += 1
                if free_doc[j : j + length].all():
                    tiles.append((i, j, length))
                    free_item[i : i + length] = False
                    free_doc[j : j + length] = False
                    break
        high = length
    return tiles


def short_items(w: Words, known: Index) -> list[tuple[int, int, float, list]]:
    """Pairs of a row and an item without a seed that it has whole, at the first place."""
    found = {}
    for n, (hashes, items) in known.short.items():
        every = runs(w.value, n)
        for at in np.flatnonzero(np.isin(every, hashes)).tolist():
            row = int(np.searchsorted(w.first, at, "right")) - 1
            if at + n <= w.first[row + 1]:
                low, high = np.searchsorted(hashes, every[at]), np.searchsorted(hashes, every[at], "right")
                for number in items[low:high].tolist():
                    found.setdefault((row, number), (row, number, 1.0, [(0, int(at - w.first[row]), n)]))
    return list(found.values())


def search(column: pa.Array, known: Index, least: int, coverage: float, long: int = LONG) -> list[tuple[int, int, float, list]]:
    """(row, item number, covered share, tiles) of each contaminated pair."""
    w = words(pc.utf8_lower(column))
    return short_items(w, known) + seeded(w, known, least, coverage, long)


def seeded(w: Words, known: Index, least: int, coverage: float, long: int) -> list[tuple[int, int, float, list]]:
    every = runs(w.value, least)
    at = np.flatnonzero(known.maybe[every >> np.uint64(64 - FILTER_BITS)])
    if not len(at) or not len(known.seed):
        return []
    low = np.searchsorted(known.seed, every[at])
    at = at[known.seed[np.minimum(low, len(known.seed) - 1)] == every[at]]
    owner = np.searchsorted(w.first, at, "right") - 1
    inside = at + least <= w.first[owner + 1]
    at, owner = at[inside], owner[inside]
    found = []
    rows, starts = np.unique(owner, return_index=True)
    for row, some in zip(rows.tolist(), np.split(at, starts[1:])):
        low, high = np.searchsorted(known.seed, every[some]), np.searchsorted(known.seed, every[some], "right")
        hits = np.repeat(high - low, high - low)
        entry = np.repeat(low, high - low) + np.arange(len(hits)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
        place_in_doc = np.repeat(some - w.first[row], high - low)
        item = known.item[entry]
        doc = w.value[w.first[row] : w.first[row + 1]]
        for number in np.unique(item).tolist():
            mine = item == number
            text = known.value[known.first[number] : known.first[number + 1]]
            reach = np.zeros(len(text), bool)
            for j in range(least):
                reach[known.place[entry[mine]] + j] = True
            if reach.sum() < min(coverage * len(text), long):
                continue
            # Only words inside seeds can be in a tile; the rest of the document is cut away.
            usable = np.zeros(len(doc), bool)
            for j in range(least):
                usable[place_in_doc[mine] + j] = True
            keep = usable.copy()
            keep[1:] |= usable[:-1]  # one unusable word stays as a border
            position = np.flatnonzero(keep)
            tiles = tiling(text, doc[position], usable[position], least)
            share = sum(t[2] for t in tiles) / len(text)
            if share >= coverage or (tiles and tiles[0][2] >= long):
                found.append((row, number, share, [(i, int(position[j]), n) for i, j, n in tiles]))
    return found


def passes(benchmark: DataFrame, id_col: str, text_col: str, pass_bytes: int) -> list[DataFrame]:
    """The benchmark in parts of about ``pass_bytes`` of text each, by a hash; items without text are left out, those without id are not."""
    items = narrow(benchmark, item_id=id_col, text=text_col).filter("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // pass_bytes))
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p) for p in range(parts)]


def _indexes(docs, benchmark, least, item_col, item_text_col, pass_bytes):
    for part in passes(benchmark, item_col, item_text_col, pass_bytes):
        rows = part.orderBy("item_id", "text").collect()  # about pass_bytes
        known = index([r.item_id for r in rows], [r.text for r in rows], least)
        yield docs.sparkSession.sparkContext.broadcast(known)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = LEAST,
    coverage: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    pass_bytes: int = PASS_BYTES,
    long: int = LONG,
) -> DataFrame:
    """``doc_id, item_id, coverage, tiles`` for each document and item with tiles over ``coverage`` of the item's words, or with a tile
    of ``long`` words.

    Words stand between ASCII white space and are compared in lower case. An item of fewer than ``least`` words is found where a document
    has it whole, one without words nowhere; an item with a null id is searched for like any other. Documents without a hit have no row; a null text is empty; repeated documents each have
    theirs, and a null id stays null; repeated items count once; other columns are ignored; empty tables give an
    empty result. The benchmark is the query set: parts of a fixed size go to the workers one after the
    other, each in a pass over all documents, without a shuffle of the documents.
    """
    doc_kind, item_kind = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)[item_col]
    rows = narrow(docs, doc_id=id_col, text=text_col)
    item_type = pa.int64() if item_kind == "bigint" else None
    out = None
    for known in _indexes(docs, benchmark, least, item_col, item_text_col, pass_bytes):

        def work(block: pa.RecordBatch, known=known) -> pa.RecordBatch | None:
            found = search(block.column(1), known.value, least, coverage, long)
            if not found:
                return None
            tiles = [[dict(zip(("item_start", "doc_start", "words"), t)) for t in some] for *_, some in found]
            return batch(
                ["doc_id", "item_id", "coverage", "tiles"],
                [
                    block.column(0).take(pa.array([r for r, *_ in found])),
                    pa.array([known.value.ids[i] for _, i, *_ in found], item_type),
                    pa.array([s for _, _, s, _ in found], pa.float64()),
                    pa.array(tiles, TILE_TYPE),
                ],
            )

        part = map_blocks(rows, work, f"doc_id {doc_kind}, item_id {item_kind}, coverage double, tiles {TILES}")
        out = part if out is None else out.unionByName(part)
    return out


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = LEAST,
    coverage: float = COVERAGE,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    pass_bytes: int = PASS_BYTES,
    long: int = LONG,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text no item contaminates. Rows are judged one by one, whatever their ids."""
    at = docs.columns.index(text_col)
    for known in _indexes(docs, benchmark, least, item_col, item_text_col, pass_bytes):

        def work(block: pa.RecordBatch, known=known) -> pa.RecordBatch:
            clean = np.ones(block.num_rows, bool)
            clean[[row for row, *_ in search(block.column(at), known.value, least, coverage, long)]] = False
            return block.filter(pa.array(clean))

        docs = map_blocks(docs, work, docs.schema)
    return docs

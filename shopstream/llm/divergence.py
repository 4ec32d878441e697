"""Divergence of the sources of each language, by the distribution of their terms.

Identical texts of a language collapse first: each is kept once, with its number of copies in every source, and is
split into terms once; document frequencies and counts are added with these weights. Only cells with occurrences are kept. A
missing cell has one value for its whole group, so distances between sources follow from the cells that exist and the number of those that
do not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstream.llm.arrow import BLOCK_BYTES, blocks, map_arrow, narrow
from shopstream.llm.graph import written
from shopstream.llm.letters import letter_words, terms

# Fixed values of the contract: scale of a share, and what is added to every count.
SCALE, ADDED = 1_000_000_000, 5
# Cells that a task combines before it hands them on.
HELD_CELLS = 1_500_000
# About so many sources on each side of a tile, and terms in it, in the sums over pairs.
TILE_SOURCES = 32
TILE_TERMS = 4096


def collapsed(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, digest, text, source, n``: a row for each distinct text of a language and each source with copies of it.

    The texts cross the network once, equal ones combined before. Copies are counted on digests alone, whose two-step sum a hot text
    does not hold up.
    """
    named = narrow(docs, text=text_col, lang=lang_col, source=source_col)
    rows = named.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    texts = rows.groupBy("lang", "digest").agg(F.min("text").alias("text"))
    copies = rows.groupBy("lang", "digest", "source").agg(F.count("*").alias("n"))
    return texts.join(copies, ["lang", "digest"])


def term_cells(texts: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of each term in each group and documents with it, summed over all copies.

    Rows of one text follow each other, so it is split once for all its sources.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for some in batches:
            for block in blocks(some, BLOCK_BYTES):
                held.append(cells(block))
                if sum(t.num_rows for t in held) > HELD_CELLS:
                    held = [summed(held)]
                    if held[0].num_rows > HELD_CELLS // 2:
                        yield from held.pop().to_batches()
        if held:
            yield from summed(held).to_batches()

    found = map_arrow(texts, run, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def summed(tables: list[pa.Table]) -> pa.Table:
    """Equal cells of some tables added up."""
    whole = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return whole.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"])


def cells(block: pa.RecordBatch) -> pa.Table:
    """Cells of a block of ``lang, digest, text, source, n``."""
    lang, digest, text, source, copies = block.columns
    rows = block.num_rows
    # A run of rows with the same text.
    new = np.ones(rows, bool)
    if rows > 1:
        same = pc.and_(pc.equal(lang.slice(1), lang.slice(0, rows - 1)), pc.equal(digest.slice(1), digest.slice(0, rows - 1)))
        new[1:] = ~same.to_numpy(zero_copy_only=False)
    at = np.flatnonzero(new)
    w = letter_words(text.take(pa.array(at)))
    coded = terms(w).dictionary_encode()
    width = max(len(coded.dictionary), 1)
    owner = np.repeat(np.arange(len(at)), np.diff(w.first))
    pairs, times = np.unique(owner * width + np.asarray(coded.indices, np.int64), return_counts=True)
    # Each run's terms, once for every row of the run.
    first = np.searchsorted(pairs, np.arange(len(at) + 1) * width)
    run = np.cumsum(new) - 1
    size = np.diff(first)[run]
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    place = np.repeat(first[:-1][run], size) + within
    groups = pa.StructArray.from_arrays([lang, source], ["lang", "source"])
    keys, group = _codes(groups)
    weight = np.asarray(copies, np.int64)
    cell = np.repeat(group, size) * width + pairs[place] % width
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    start = np.flatnonzero(np.diff(cell, prepend=-1))
    docs = np.repeat(weight, size)[order]
    counts = times[place][order] * docs
    add = lambda values: np.add.reduceat(values, start) if len(start) else values
    found = cell[start]
    return pa.table(
        {
            "lang": keys.field(0).take(pa.array(found // width)),
            "source": keys.field(1).take(pa.array(found // width)),
            "term": coded.dictionary.take(pa.array(found % width)),
            "n": pa.array(add(counts), pa.int64()),
            "docs": pa.array(add(docs), pa.int64()),
        }
    )


def _codes(groups: pa.StructArray) -> tuple[pa.StructArray, np.ndarray]:
    """(distinct pairs, number of each row's pair)."""
    a, b = groups.field(0).dictionary_encode(), groups.field(1).dictionary_encode()
    both = np.asarray(a.indices, np.int64) * max(len(b.dictionary), 1) + np.asarray(b.indices, np.int64)
    values, first, code = np.unique(both, return_index=True, return_inverse=True)
    return groups.take(pa.array(first)), code.reshape(-1)


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + ADDED) / (total + ADDED * kept)), in whole numbers of any size."""
    wide = lambda c: c.cast("decimal(38,0)")
    above = wide(F.lit(SCALE)) * wide(count + F.lit(ADDED))
    return F.call_function("div", above.cast("decimal(38,0)"), wide(total + F.lit(ADDED) * kept)) + 1


def shares(cells: DataFrame, groups: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(cells of the kept terms, groups).

    Cells: ``lang, source, term, p, q``; ``q`` is the share of the term in its whole language. Groups: ``lang, source, kept, zero``; ``kept``
    terms has the language, ``zero`` is the share of one that the group lacks, NULL where the language keeps none.
    """
    kept = cells.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs"))
    kept = written(kept.filter(F.col("docs") >= least).select("lang", "term", "all"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all").alias("lang_total"))
    some = written(cells.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "all"), "kept-cells")
    totals = some.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    facts = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    facts = written(facts.fillna(0, ["kept", "total", "lang_total"]), "groups")
    p = _share(F.col("n"), F.col("total"), F.col("kept"))
    q = _share(F.col("all"), F.col("lang_total"), F.col("kept"))
    valued = some.join(facts, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), q.alias("q"))
    zero = F.when(F.col("kept") > 0, _share(F.lit(0), F.col("total"), F.col("kept")))
    return valued, facts.select("lang", "source", "kept", zero.alias("zero"))


def distances(valued: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: the differences of two sources' shares summed over the kept terms, for each ordered pair.

    With ``z`` the share of a missing cell, the sum is that of ``|z - z'|`` over all kept terms, corrected where a cell exists. Corrections
    are made in tiles of a limited number of sources and terms; every cell goes once to each tile of its chunk of sources.
    """
    per_lang = groups.groupBy("lang").agg(
        F.ceil(F.count("*") / TILE_SOURCES).cast("int").alias("chunks"), F.ceil(F.max("kept") / TILE_TERMS).cast("int").alias("lanes")
    )
    dealt = groups.join(per_lang, "lang").withColumn("chunk", F.pmod(F.xxhash64("source"), F.col("chunks")).cast("int"))
    dealt = written(dealt, "dealt")
    lane = F.pmod(F.xxhash64("term"), F.col("lanes")).cast("int").alias("lane")
    cell = valued.join(dealt, ["lang", "source"]).select("lang", "source", "chunk", "chunks", lane, "term", "p", "zero")
    # A source without a term in a lane has to be known there too.
    lanes = F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane")
    marks = dealt.filter("kept > 0").select("lang", "source", "chunk", "chunks", lanes, F.lit(None).cast("string").alias("term"), "zero")
    both = cell.unionByName(marks.withColumn("p", F.col("zero")))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    sent = both.select("*", other).select(
        "lang", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "lane", "chunk", "source", "term", "p", "zero"
    )
    met = sent.groupBy("lang", "low", "high", "lane").applyInArrow(meet, "lang string, source string, item string, value bigint")
    met = met.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    turned = met.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    a = dealt.select("lang", "source", "kept", "zero")
    b = dealt.select("lang", F.col("source").alias("item"), F.col("zero").alias("other"))
    pairs = a.join(b, "lang").filter("source <> item")
    base = F.coalesce(F.col("kept") * F.abs(F.col("zero") - F.col("other")), F.lit(0))
    return pairs.join(met.unionByName(turned), ["lang", "source", "item"], "left").select(
        "lang", "source", "item", (base + F.coalesce("value", F.lit(0))).alias("value")
    )


def meet(tile: pa.Table) -> pa.Table:
    """Corrections of the pairs of a tile, each in one direction. Rows without a term only make their source known."""
    lang, low, high = (tile[c][0].as_py() for c in ("lang", "low", "high"))
    coded = tile["source"].combine_chunks().dictionary_encode()
    sources, of = coded.dictionary, np.asarray(coded.indices)
    zero, chunk = np.zeros(len(sources), np.int64), np.zeros(len(sources), np.int64)
    zero[of], chunk[of] = tile["zero"].to_numpy(), tile["chunk"].to_numpy()
    named = tile["term"].combine_chunks().dictionary_encode()
    has = named.is_valid().to_numpy(zero_copy_only=False)
    width = len(named.dictionary)
    share = np.repeat(zero[:, None], width, axis=1)
    share[of[has], np.asarray(named.indices.drop_null())] = tile["p"].to_numpy()[has]
    left, right, value = [], [], []
    # One direction, the same in all tiles of a pair: from the lower chunk, in a chunk from the lesser name.
    place = np.empty(len(sources), np.int64)
    place[sorted(range(len(sources)), key=sources.to_pylist().__getitem__)] = np.arange(len(sources))
    for a in np.flatnonzero(chunk == low).tolist():
        others = np.flatnonzero(chunk == high)
        if low == high:
            others = others[place[others] > place[a]]
        sums = np.abs(share[others] - share[a]).sum(1) - width * np.abs(zero[others] - zero[a])
        left += [a] * len(others)
        right += others.tolist()
        value.append(sums)
    names = pa.array(sources.to_pylist(), pa.string())
    return pa.table(
        {
            "lang": pa.array([lang] * len(left), pa.string()),
            "source": names.take(pa.array(left, pa.int64())),
            "item": names.take(pa.array(right, pa.int64())),
            "value": pa.array(np.concatenate(value) if value else [], pa.int64()),
        }
    )


def audit(
    docs: DataFrame,
    least: int = 30,
    top: int = 50,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for each source of each language.

    Terms in at least ``least`` documents of a language are kept. Part ``pair``: each other source of the language by the summed
    difference of shares. Part ``term``: the ``top`` terms whose share in the source most exceeds that in the language. Ranks start at 1, by
    falling value, then rising item.

    Null text, language or source counts as empty; such languages and sources are as any other. A group without terms has pairs and no term rows;
    where a language keeps no term its pairs have value 0. Very long texts are split whole. Repeated rows count each. Documents
    need no id; other columns are ignored, whatever their names. An empty table gives no row.
    """
    texts = collapsed(docs, text_col, lang_col, source_col)
    found = written(term_cells(texts), "term-cells")
    named = narrow(docs, lang=lang_col, source=source_col)
    groups = named.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    valued, groups = shares(found, groups, least)
    valued = written(valued, "shares")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = distances(valued, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    over = valued.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    over = over.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.unionByName(over)

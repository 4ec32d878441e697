"""N-gram Jaccard join by a blocked sparse matrix product.

Rows of the matrix are the distinct shingle sets of the documents, columns the shingles. The product of the matrix with
its transpose counts the shingles that two sets share; a pair is a link if the count reaches the
bound that the two sizes give. The whole product is never formed; blocks of rows are chosen so that every link is inside
some product of two blocks:

1. Equal sets are one row of the matrix, so copies cost nothing further.
2. Sizes fall into classes. Sets of a class differ in ``k`` shingles at most if they are linked, by
   their sizes. The range of shingle hashes is cut into ``k + 1 + s`` parts; linked sets agree entirely in
   ``s + 1`` parts at least. The hash of a part is a signature; each set may leave out the ``s`` signatures that most sets have, and
   linked sets still share one. A passage common to many texts falls under those left out, unless it is much of the text.
3. A sketch of a set has a bit for each remainder of the shingle hashes, odd counts being 1. Two sets differ in as many shingles
   as their sketches differ in bits, or more, so sketches that differ too much tell for certain that there is no link.
   A sketch is a small part of the text; only texts whose sketches are near are ever compared.
4. First each set is compared with the leader it shares most signatures with, which connects most near copies. Then sketches of sets that
   share a signature and are not connected yet are compared, first until they would be connected if all near sketches were links, then,
   where some were not, all of them.

Texts are compared in tiles of one set with others. A tile gives back a spanning forest of its links, not its pairs.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstream.llm.arrow import SMALL_BLOCK_BYTES, batch, importable, lean, map_blocks, narrow
from shopstream.llm.graph import components, written
from shopstream.llm.words import mix, shingle_sets, words

# Sets, and shingles of all its sets, of a row block.
BLOCK_ROWS = 2048
BLOCK_SHINGLES = 2_000_000
# Entries of a column block of the matrix.
ENTRIES = 1 << 23
# Of so many differing parts one more is cut, to be left out.
SPARED = 4
# Bits of a sketch for each shingle that linked sets may differ in, at least.
SKETCH_BITS = 16
# Sets with a signature up to which many signatures are looked at together, and up to which all their pairs are.
SMALL, FEW = 256, 8
GROUP_ROWS = 8192
# Passes over the signatures, which are most of what is moved: each holds its share of them on disk.
PASSES = 4
# Shingles of the sets of all signatures up to which their sketches are moved at once.
PASS_SHINGLES = 64 * BLOCK_SHINGLES


class Classes:
    """Size classes for links at ``percent`` per cent or more."""

    def __init__(self, percent: int):
        if not 1 <= percent <= 100:
            raise ValueError("percent must be from 1 to 100")
        self.percent = percent
        self.ratio = max(1.5, 100 / percent)

    def low(self, c: int) -> int:
        """Smallest size of a class. A class reaches at least ``100 / percent`` times its smallest size."""
        return math.ceil(self.ratio**c)

    def of(self, size: int) -> list[int]:
        """Classes in which a set of this size is to be compared: its own, and the next if a larger partner can be there."""
        c = max(0, int(math.log(size) / math.log(self.ratio)) - 1)
        while self.low(c + 1) <= size:
            c += 1
        return [c, c + 1] if size * 100 // self.percent >= self.low(c + 1) else [c]

    def differ(self, c: int) -> int:
        """Shingles in which linked sets of a class differ at most, 0 where links are equal sets only."""
        return 2 * (self.low(c + 1) - 1) * (100 - self.percent) // (100 + self.percent)

    def spare(self, c: int) -> int:
        """Parts of a class that a set may leave out: linked sets agree in one more at least."""
        return max(1, self.differ(c) // SPARED)

    def parts(self, c: int) -> int:
        """Parts of a class, 0 where links are equal sets only."""
        return self.differ(c) + 1 + self.spare(c) if self.differ(c) else 0

    def apart(self, a, b):
        """Shingles in which linked sets of these sizes differ at most."""
        return a + b + 2 * (-(a + b) * self.percent // (100 + self.percent))


def signatures(shingles: np.ndarray, classes: Classes, spares: list[int] | None = None) -> np.ndarray:
    """Hashes of the parts of a sorted set of shingles; the lowest bit tells the classes of a set apart.

    Of all parts, linked sets agree in one more than may be left out. The signatures are put in one order for all sets, and the last
    ones left out: empty parts come last, before them those of most sets. So the empty ones are left out
    here as far as they may be. ``spares`` takes how many more may be, for even and odd classes.
    """
    out = []
    if spares is not None:
        spares[:] = [0, 0]
    if not len(shingles):
        return np.zeros(0, np.uint64)
    scattered = mix(shingles + np.uint64(0x632BE59BD9B4E019))
    for c in classes.of(len(shingles)):
        parts = classes.parts(c)
        if not parts:
            continue
        part = ((shingles >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # rises with the hash
        first = np.flatnonzero(np.diff(part, prepend=np.uint64(parts)))
        sums, number = np.add.reduceat(scattered, first), part[first]
        spare = classes.spare(c) - (parts - len(first))
        if spare < 0:
            empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), number)[: -spare]
            sums, number = np.concatenate([sums, np.zeros(len(empty), np.uint64)]), np.concatenate([number, empty])
        elif spares is not None:
            spares[c % 2] = spare
        found = mix(sums ^ mix(number + np.uint64(c << 32)))
        out.append((found & ~np.uint64(1)) | np.uint64(c % 2))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def sketch(shingles: np.ndarray, classes: Classes) -> bytes:
    """Parities of the shingles by the remainder of their hash. Half the bits are the two halves of all, one on the other."""
    n = len(shingles)
    bits = 64
    while bits < SKETCH_BITS * classes.apart(n, n * 100 // classes.percent):
        bits *= 2
    place = (mix(shingles ^ np.uint64(0x3C6EF372FE94F82B)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def halved(rows: np.ndarray) -> np.ndarray:
    """Sketches, as rows of 64-bit words, of half the bits."""
    return rows[:, : rows.shape[1] // 2] ^ rows[:, rows.shape[1] // 2 :]


def set_hashes(shingles: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """128 bits that tell a set."""
    return mix(shingles).sum(dtype=np.uint64), mix(shingles ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64)


def features(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, signatures, spares, sketch``: the size, 128 hash bits, signatures and sketch of each row's set."""
    classes = Classes(percent)

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(words(block.column(1)), k)
        spares = [[0, 0] for _ in sets]
        signed = [signatures(s, classes, left) for s, left in zip(sets, spares)]
        flat = np.concatenate([np.zeros(0, np.uint64), *signed]).view(np.int64)
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in signed])]).astype(np.int32)
        hashes = np.array([set_hashes(s) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
        return batch(
            ["doc_id", "n_shingles", "set_a", "set_b", "signatures", "spares", "sketch"],
            [
                block.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(hashes[:, 0]), pa.array(hashes[:, 1]),
                pa.ListArray.from_arrays(offsets, flat), pa.array(spares, pa.list_(pa.int32())),
                pa.array([sketch(s, classes) for s in sets], pa.binary()),
            ],
        )

    kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {kind}, n_shingles bigint, set_a bigint, set_b bigint, signatures array<bigint>, spares array<int>, sketch binary"
    return map_blocks(narrow(docs, doc_id=id_col, text=text_col), work, schema, SMALL_BLOCK_BYTES)


def overlaps(sets: list[np.ndarray], left: int | None = None) -> np.ndarray:
    """Shared shingles of each two sets: the incidence matrix times its transpose, summed over blocks of columns.

    With ``left`` the first so many sets are compared with the others only.
    """
    n = len(sets)
    above, below = (slice(n), slice(n)) if left is None else (slice(left), slice(left, n))
    sizes = [len(s) for s in sets]
    column, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    shared = count[inverse] > 1  # a column of one set adds to no pair
    place = np.cumsum(count > 1) - 1
    row, at = row[shared], place[inverse[shared]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    total = np.zeros((len(range(n)[above]), len(range(n)[below])), np.int64)
    width = max(64, ENTRIES // n)
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, width):
        a, b = np.searchsorted(at, [low, low + width])
        dense = np.zeros((n, min(width, int(at[-1]) + 1 - low)), np.float32)
        dense[row[a:b], at[a:b] - low] = 1
        # Exact: a block has far fewer than 2^24 columns.
        total += (dense[above] @ dense[below].T).astype(np.int64)
    return total


def forest(sets: list[np.ndarray], percent: int, left: int | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among these sets, as (root, member) places; with ``left`` of those between the two sides."""
    size = np.array([len(s) for s in sets], np.int64)
    rows, columns = (size, size) if left is None else (size[:left], size[left:])
    linked = np.empty((len(rows), len(columns)), bool)
    for i, shared in enumerate(overlaps(sets, left)):
        linked[i] = shared * (100 + percent) >= percent * (columns + rows[i])
    out, open_rows, open_columns = [], np.ones(len(rows), bool), np.ones(len(columns), bool)
    if left is None:
        open_columns = open_rows  # the same sets
    for root in range(len(rows)):
        if not open_rows[root]:
            continue
        open_rows[root] = False
        front = np.array([root])
        while len(front):
            found = np.flatnonzero(linked[front].any(0) & open_columns)
            open_columns[found] = False
            out += [(root, int(m) + (left or 0)) for m in found]
            if left is not None:
                found = np.flatnonzero(linked[:, found].any(1) & open_rows)
                open_rows[found] = False
                out += [(root, int(m)) for m in found]
            front = found
    return out


def products(tiles: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Edges ``a, b`` found in each tile. ``tiles`` has ``tile, side, node``, ``texts`` has ``node, text``.

    A tile whose rows are all of side 0 is a block by itself, else two blocks whose sets are compared with those of the other.
    """

    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side, node = table["side"].to_numpy(), table["node"].to_numpy()
        order = np.lexsort((node, side))
        order = order[np.concatenate([[True], np.diff(node[order]) != 0])[: len(order)]]
        node = node[order]
        text = table["text"].take(pa.array(order)).combine_chunks()
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        left = int((side[order] == 0).sum())
        left = left if left < len(node) else None
        found = forest(shingle_sets(words(text), k), percent, left) if len(node) > 1 and left != 0 else []
        pairs = node[np.array(found, np.int64).reshape(-1, 2)]
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    importable(tiles.sparkSession)
    return tiles.join(texts, "node").groupBy("tile").applyInArrow(lean(work), "a bigint, b bigint")


def blocks_of(rows: DataFrame, group: str) -> DataFrame:
    """With ``chunks`` and ``chunk``: sets of a group dealt over as many chunks as keep each within the bounds of a block."""
    sizes = rows.groupBy(group).agg(
        F.greatest(
            F.ceil(F.count("*") / F.lit(BLOCK_ROWS)), F.ceil(F.sum("n_shingles") / F.lit(BLOCK_SHINGLES))
        ).cast("int").alias("chunks"),
        F.count("*").alias("size"),
    )
    return rows.join(sizes, group).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))


def buckets(signed: DataFrame, *more: str) -> DataFrame:
    """``signature, node, leader, members`` of the signatures that two sets share."""
    # Dealt once, for the groups and for the join with them.
    dealt = signed.select("signature", "node", *more).repartition("signature")
    shared = (
        dealt.groupBy("signature")
        .agg(F.min("node").alias("leader"), F.max("node").alias("last"), F.count("*").alias("members"))
        .filter("leader < last")
        .drop("last")
    )
    return dealt.join(shared, "signature")


def meetings(rows: DataFrame, nodes: DataFrame, key: list[str], number: int) -> DataFrame:
    """The shared signatures of those that one pass looks at, with ``spare``: how many signatures of its class the set may leave out."""
    mine = F.filter("signatures", lambda s: F.pmod(F.shiftright(s, 1), F.lit(PASSES)) == number).alias("signatures")
    # The signatures of one row of each set; the id in the key spreads groups of copies.
    owners = rows.select(*key, F.col("doc_id").alias("least"), "spares", mine).join(nodes, [*key, "least"])
    signed = owners.select("node", "spares", F.explode("signatures").alias("signature"))
    own = F.when(F.col("signature").bitwiseAND(1) == 1, F.col("spares")[1]).otherwise(F.col("spares")[0])
    return buckets(signed.withColumn("spare", own), "spare")


def rarest(met: DataFrame) -> DataFrame:
    """Without the signatures that a set may leave out: those of most sets, in an order that is the same for all sets."""
    order = Window.partitionBy("node", F.col("signature").bitwiseAND(1)).orderBy(F.desc("members"), "signature")
    return met.withColumn("place", F.row_number().over(order)).filter("place > spare").select("signature", "node")


class Sketches:
    """Sketches of some sets, cut to the lengths that occur among them."""

    def __init__(self, column: pa.Array, size: np.ndarray, percent: int):
        made = [np.frombuffer(b, np.uint64) for b in column.to_pylist()]
        self.size, self.classes = size, Classes(percent)
        self.length = np.array([len(m) for m in made], np.int64)
        self.rows, self.place = {}, {}
        have, at = np.zeros((0, 0), np.uint64), np.zeros(0, np.int64)
        for length in np.unique(self.length)[::-1].tolist():
            while have.shape[1] > length:
                have = halved(have)
            new = np.flatnonzero(self.length == length)
            have = np.concatenate([have.reshape(-1, length), np.stack([made[i] for i in new])])
            at = np.concatenate([at, new])
            self.rows[length] = have
            self.place[length] = np.full(len(made), -1)
            self.place[length][at] = np.arange(len(at))

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each two sets can be linked."""
        most = self.classes.apart(self.size[a], self.size[b])
        out = np.abs(self.size[a] - self.size[b]) <= most
        length = np.minimum(self.length[a], self.length[b])
        for n in np.unique(length[out]).tolist():
            here = np.flatnonzero(out & (length == n))
            step = max(1, (1 << 20) // n)
            for low in range(0, len(here), step):
                part = here[low : low + step]
                rows, place = self.rows[n], self.place[n]
                apart = np.bitwise_count(rows[place[a[part]]] ^ rows[place[b[part]]]).sum(1, dtype=np.int64)
                out[part] = apart <= most[part]
        return out


def all_near(found: Sketches, at: np.ndarray, label: np.ndarray, side: np.ndarray) -> list[np.ndarray]:
    """Pairs of near sets among those ``at``, of different labels and, where there are two sides, of both."""
    out, both = [], len(np.unique(side[at])) > 1
    for i, a in enumerate(at[:-1]):
        b = at[i + 1 :]
        b = b[(label[b] != label[a]) & ((side[b] != side[a]) | (not both))]
        b = b[found.near(np.full(len(b), a), b)]
        out.append(np.stack([np.full(len(b), a), b], 1))
    return out


def enough_near(found: Sketches, at: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """Pairs of near sets that connect all labels which near sets connect."""
    out, open_ = [], np.ones(len(at), bool)
    own = label[at]
    for root in range(len(at)):
        if not open_[root]:
            continue
        front = np.flatnonzero(own == own[root]).tolist()
        open_[front] = False
        while front and open_.any():
            a = at[front.pop()]
            rest = np.flatnonzero(open_)
            b = rest[found.near(np.full(len(rest), a), at[rest])]
            _, first = np.unique(own[b], return_index=True)
            out.append(np.stack([np.full(len(first), a), at[b[first]]], 1))
            reached = open_ & np.isin(own, own[b])
            open_ &= ~reached
            front += np.flatnonzero(reached).tolist()
    return out


def candidates(placed: DataFrame, about: DataFrame, percent: int, whole: bool) -> DataFrame:
    """Pairs ``a, b`` of near sketches that share a signature and have different labels; all, or enough to connect what they connect.

    ``placed`` has ``signature, node, label, n_shingles`` of the signatures whose sets are not all connected.
    """

    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        signature, node, label, side = (table[c].to_numpy() for c in ("signature", "node", "label", "side"))
        sketches = Sketches(table["sketch"], table["n_shingles"].to_numpy(), percent)
        order = np.lexsort((node, signature))
        first = np.flatnonzero(np.concatenate([[True], np.diff(signature[order]) != 0]))
        size = np.diff(np.append(first, len(order)))
        out = [np.zeros((0, 2), np.int64)]
        for n in np.unique(size).tolist():
            here = order[first[size == n][:, None] + np.arange(n)]
            if n <= FEW:
                a, b = (here[:, i].ravel() for i in np.triu_indices(n, 1))
                apart = label[a] != label[b]
                a, b = a[apart], b[apart]
                near = sketches.near(a, b)
                out.append(np.stack([a[near], b[near]], 1))
            else:
                for at in here:
                    out += all_near(sketches, at, label, side) if whole else enough_near(sketches, at, label)
        pairs = np.concatenate(out)
        low, high = np.minimum(node[pairs[:, 0]], node[pairs[:, 1]]), np.maximum(node[pairs[:, 0]], node[pairs[:, 1]])
        labels = np.sort(label[pairs], 1)
        return pa.table({"a": low, "b": high, "label_a": labels[:, 0], "label_b": labels[:, 1]})

    importable(placed.sparkSession)
    made = []
    # A sketch has about a byte a shingle; few are looked at in one pass.
    passes = PASSES if (placed.agg(F.sum("n_shingles")).first()[0] or 0) > PASS_SHINGLES else 1
    for number in range(passes):
        rows = blocks_of(placed.filter(F.pmod(F.shiftright("signature", 1), F.lit(passes)) == number), "signature")
        held = rows.agg(F.count("*"), F.sum("n_shingles")).first()
        if not held[0]:
            continue
        groups = max(math.ceil(held[0] / GROUP_ROWS), math.ceil(held[1] / BLOCK_SHINGLES))
        together = (F.col("chunks") == 1) & (F.col("size") <= SMALL)
        # Each chunk of a signature meets each.
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        tile = F.struct(
            together.alias("together"),
            F.when(together, F.pmod(F.xxhash64("signature"), F.lit(groups))).otherwise(F.col("signature")).alias("key"),
            F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
        )
        rows = rows.select(tile.alias("tile"), "signature", "node", "label", "n_shingles", F.col("chunk").alias("side"))
        found = rows.join(about.select("node", "sketch"), "node").groupBy("tile").applyInArrow(lean(work), "a bigint, b bigint, label_a bigint, label_b bigint")
        made.append(written(found, "near"))
    if not made:
        return placed.select(*(F.lit(0).cast("bigint").alias(c) for c in ("a", "b", "label_a", "label_b"))).limit(0)
    near = reduce(DataFrame.unionByName, made)
    if whole:
        return near.select("a", "b").distinct()
    one = near.groupBy("label_a", "label_b").agg(F.min(F.struct("a", "b")).alias("pair"))
    return one.select("pair.a", "pair.b").distinct()


def near_ones(pairs: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` whose sketches are near."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        n = block.num_rows
        column = pa.concat_arrays([block.column("sketch_a"), block.column("sketch_b")])
        size = np.concatenate([block.column("n_a").to_numpy(), block.column("n_b").to_numpy()])
        near = Sketches(column, size, percent).near(np.arange(n), np.arange(n, 2 * n))
        return block.select(["a", "b"]).filter(pa.array(near))

    side = lambda s: about.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
    return map_blocks(both, work, "a bigint, b bigint")


def jaccard_components(
    docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs``.

    A set holds the distinct ``k``-word shingles (A-Z lower-cased, words between ASCII white space); of
    fewer words the whole sequence; of none, or of a null text, nothing. Sets are linked where the shared shingles are
    ``percent`` per cent or more of all; empty sets are linked with nothing. ``component_id`` is the smallest
    id that links reach, the own one included. Rows are not merged: repeated rows each come out; a row with a null id has
    a null component and takes no part. Other columns are ignored; an empty table gives an empty result.
    Exact up to collisions of 64-bit hashes; no cap on group or bucket sizes.
    """
    made = written(features(docs, k, percent, id_col, text_col), "features")
    rows = made.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    key = ["set_a", "set_b", "n_shingles"]
    nodes = written(
        rows.groupBy(*key).agg(F.min("doc_id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    every_met = reduce(DataFrame.unionByName, [written(meetings(rows, nodes, key, p), "met") for p in range(PASSES)])
    kept = written(rarest(every_met), "kept")
    met = written(buckets(kept), "met")
    involved = nodes.join(met.select("node").distinct(), "node")
    about = written(
        rows.select(*key, F.col("doc_id").alias("least"), "sketch").join(involved, [*key, "least"]).dropDuplicates(["node"]), "about"
    )

    def links(pairs: DataFrame) -> DataFrame:
        """Those of the pairs ``a, b`` that are links."""
        sized = pairs.join(about.select(F.col("node").alias("b"), "n_shingles"), "b")
        dealt = blocks_of(sized.withColumnRenamed("b", "node"), "a").select(F.struct("a", "chunk").alias("tile"), "node")
        tiles = dealt.select("tile", F.lit(1).alias("side"), "node").unionByName(
            dealt.select("tile", F.lit(0).alias("side"), F.col("tile.a").alias("node")).distinct()
        )
        named = tiles.select("node").distinct().join(about.select("node", *key, "least"), "node")
        return written(products(tiles, node_texts(docs, named, k, id_col, text_col), k, percent), "links")

    # The leader that a set meets most often.
    anchors = (
        met.filter("node <> leader").groupBy("node", "leader").agg(F.count("*").alias("times"))
        .groupBy("node").agg(F.max(F.struct("times", (-F.col("leader")).alias("minus"))).alias("best"))
        .select((-F.col("best.minus")).alias("a"), F.col("node").alias("b"))
    )
    labels = components(links(written(near_ones(anchors, about, percent), "anchors")))

    def unsettled() -> DataFrame:
        """Signatures whose sets are not all connected yet."""
        label = F.coalesce("label", "node").alias("label")
        placed = met.select("signature", "node").join(about.select("node", "n_shingles"), "node").join(labels, "node", "left")
        placed = placed.select("signature", "node", label, "n_shingles").repartition("signature")
        open_ = placed.groupBy("signature").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
        return written(placed.join(open_.select("signature"), "signature", "left_semi"), "open")

    def joined(more: DataFrame) -> DataFrame:
        return components(labels.select(F.col("label").alias("a"), F.col("node").alias("b")).unionByName(more))

    pairs = written(candidates(unsettled(), about, percent, whole=False), "pairs")
    found = links(pairs)
    labels = joined(found)
    if found.count() < pairs.count():
        # A near pair that was no link may have stood for others that are.
        rest = candidates(unsettled(), about, percent, whole=True).join(pairs, ["a", "b"], "left_anti")
        labels = joined(links(written(rest, "pairs")))

    known = nodes.join(labels, "node", "left").select(*key, "least", F.coalesce("label", "node").alias("label"))
    smallest = known.groupBy("label").agg(F.min("least").alias("component_id"))
    of_set = known.join(smallest, "label").select(*key, "component_id")
    every = made.drop("signatures", "spares", "sketch").join(of_set, key, "left")
    alone = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return every.select("doc_id", "n_shingles", alone.alias("component_id"))


# Ids that are sent to all tasks rather than having all texts dealt by id: counted first.
SENT_IDS = 4_000_000


def node_texts(docs: DataFrame, involved: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """``node, text`` of the sets that share a signature, each from a row that has the set.

    Rows are chosen by id first, which copies none, then by the hashes of their own set: any number of rows and of sets may have
    one id.
    """
    ids = involved.select(F.col("least").alias("doc_id")).distinct()
    few = ids.count() <= SENT_IDS
    rows = narrow(docs, doc_id=id_col, text=text_col).join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(words(block.column(1)), k)
        hashes = np.array([set_hashes(s) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
        sizes = pa.array([len(s) for s in sets], pa.int64())
        return batch(["doc_id", "set_a", "set_b", "n_shingles", "text"], [block.column(0), pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), sizes, block.column(1)])

    kind = dict(docs.dtypes)[id_col]
    found = map_blocks(rows, work, f"doc_id {kind}, set_a bigint, set_b bigint, n_shingles bigint, text string", SMALL_BLOCK_BYTES)
    key = ["doc_id", "set_a", "set_b", "n_shingles"]
    return found.dropDuplicates(key).join(involved.withColumnRenamed("least", "doc_id"), key).select("node", "text")


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, that of the smallest id.

    Rows are compared by their texts, whatever their ids: each gets a number of its own first. Rows with a null id
    take part in the links, and where a component has such rows one of them stays beside that of the smallest id.
    Rows without a word are linked with nothing and all stay.
    """
    number = "row"
    while number in (c.lower() for c in docs.columns):
        number += "_"
    rows = written(docs.withColumn(number, F.monotonically_increasing_id()), "rows")
    found = jaccard_components(rows, k, percent, number, text_col)
    group = found.select(F.col("doc_id").alias(number), "component_id")
    ids = rows.select(number, F.col(f"`{id_col}`").alias("id"))
    least = group.join(ids, number).groupBy("component_id", F.col("id").isNull().alias("nameless")).agg(
        F.min(F.struct("id", number))[number].alias(number)
    )
    return rows.join(least.select(number), number, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))

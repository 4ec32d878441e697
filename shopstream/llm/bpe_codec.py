"""Byte-level BPE encoding and decoding by length-bucketed padded numpy matrices.

The distinct pieces of a block that are new to a worker are put into matrices, one for each length bucket: a row
is a piece, a column a symbol, the rest padding. In each round every row merges its
leftmost pair of minimum rank; the symbols behind it move up by one column, and rows
without a pair left leave the matrix. Ranks of pairs come from a hash table held in numpy arrays.
"""

from __future__ import annotations

import base64
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.arrow import batch, map_blocks, narrow, texts
from shopstream.llm.pretokens import Memory, Pieces
from shopstream.llm.token_count import merges

NONE = np.int32(2**31 - 1)
# Bytes of the longest piece of each matrix; longer pieces merge by heap, as the work of a
# row here grows with the square of its length.
BUCKETS = (4, 8, 12, 16, 24, 32, 64, 128)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

_models: dict[tuple, object] = {}


class PairTable:
    """Rank (which is also the identifier) of the token that two adjacent tokens make."""

    def __init__(self, ranks: dict[bytes, int]):
        found = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    found[a, b] = rank
        self.by_pair = {a << 32 | b: rank for (a, b), rank in found.items()}
        bits = max(4, int(len(found) * 2).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, NONE, np.int32)
        keys = np.array([a << 32 | b for a, b in found], np.int64)
        values = np.array(list(found.values()), np.int32)
        at = self.slots(keys)
        self.probes = 0
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]  # of keys for one slot the last stays
            placed = self.keys[at] == keys
            self.values[at[placed]] = values[placed]
            keys, values, at = keys[~placed], values[~placed], (at[~placed] + 1) & self.mask
            self.probes += 1

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _MULTIPLIER >> self.shift).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank for each pair, NONE where there is none or a side is padding (negative)."""
        out = np.full(left.shape, NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left.ravel()[todo].astype(np.int64) << 32 | right.ravel()[todo]
        at, flat = self.slots(keys), out.reshape(-1)
        for _ in range(self.probes):
            there = self.keys[at]
            hit = there == keys
            flat[todo[hit]] = self.values[at[hit]]
            more = ~hit & (there != -1)
            if not more.any():
                break
            todo, keys, at = todo[more], keys[more], (at[more] + 1) & self.mask
        return out


def read_ranks(file: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, file.splitlines()))}


class Encoder:
    def __init__(self, file: bytes, pattern: str):
        self.ranks = read_ranks(file)
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"ranks lack the bytes {missing}")
        self.pairs = PairTable(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pieces = Pieces(pattern)
        self.by_piece, self.by_word = Memory(size=150_000), Memory(size=100_000)

    def encode(self, found: list[str]) -> list[bytes]:
        """Identifiers of each text, as packed 32-bit integers."""
        cut = [self.pieces.words(t) for t in found]
        word_ids, new = self.by_word.known(set(chain.from_iterable(words for _, words in cut)))
        inside = [self.pieces.word(w) for w in new]
        piece_ids, rest = self.by_piece.known(set(chain(*inside, *(pieces for pieces, _ in cut))))
        piece_ids |= self.by_piece.learn(self.encode_pieces(rest))
        of_piece, of_word = piece_ids.__getitem__, word_ids.__getitem__
        word_ids |= self.by_word.learn({w: b"".join(map(of_piece, some)) for w, some in zip(new, inside)})
        return [b"".join(map(of_piece, pieces)) + b"".join(map(of_word, words)) for pieces, words in cut]

    def encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        out, rest = {}, []
        for piece in pieces:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                out[piece] = np.int32(whole).tobytes()
            elif len(raw) > BUCKETS[-1]:
                merged = merges(self.byte_ids[list(raw)].tolist(), self.pairs.by_pair, range(max(self.ranks.values()) + 1))
                out[piece] = np.array([i for i in merged if i >= 0], np.int32).tobytes()
            else:
                rest.append((len(raw), raw, piece))
        rest.sort()
        sizes = np.array([n for n, _, _ in rest])
        for low, high in zip((0, *BUCKETS), BUCKETS):
            some = rest[np.searchsorted(sizes, low, "right") : np.searchsorted(sizes, high, "right")]
            if some:
                out.update(zip((piece for _, _, piece in some), self.merge([raw for _, raw, _ in some], high)))
        return out

    def merge(self, raws: list[bytes], width: int) -> list[bytes]:
        n = len(raws)
        data = np.frombuffer(b"".join(raw.ljust(width, b"\0") for raw in raws), np.uint8).reshape(n, width)
        size = np.array([len(raw) for raw in raws])
        column = np.arange(width)
        ids = np.where(column < size[:, None], self.byte_ids[data], -1).astype(np.int32)
        ranks = self.pairs.lookup(ids[:, :-1], ids[:, 1:])
        rows, out = np.arange(n), [b""] * n
        while len(rows):
            at = ranks.argmin(1)  # the leftmost of equals
            best = ranks[np.arange(len(rows)), at]
            over = best == NONE
            if over.any():
                packed = ids[over].tobytes()
                for i, (row, count) in enumerate(zip(rows[over].tolist(), size[over].tolist())):
                    out[row] = packed[4 * width * i : 4 * (width * i + count)]
                keep = ~over
                rows, ids, ranks, size, at, best = rows[keep], ids[keep], ranks[keep], size[keep], at[keep], best[keep]
                if not len(rows):
                    break
            each = np.arange(len(rows))
            # Close the gap: columns behind the merged pair move one to the left.
            ids[:, 1:-1] = np.where(column[1:-1] > at[:, None], ids[:, 2:], ids[:, 1:-1])
            ids[:, -1] = -1
            ids[each, at] = best
            ranks[:, :-1] = np.where(column[:-2] > at[:, None], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NONE
            size -= 1
            right = np.minimum(at + 1, width - 1)
            ranks[each, np.minimum(at, width - 2)] = self.pairs.lookup(ids[each, at], ids[each, right])
            some = at > 0
            ranks[each[some], at[some] - 1] = self.pairs.lookup(ids[each[some], at[some] - 1], ids[each[some], at[some]])
        return out


class Decoder:
    def __init__(self, file: bytes):
        ranks = read_ranks(file)
        lengths = np.zeros(max(ranks.values()) + 2, np.int64)
        for token, rank in ranks.items():
            lengths[rank + 1] = len(token)
        self.lengths, self.starts = lengths[1:], np.cumsum(lengths)[:-1]
        self.data = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)

    def decode(self, flat: np.ndarray) -> np.ndarray:
        """Bytes of the identifiers, one after the other."""
        if len(flat) and (flat.min() < 0 or flat.max() >= len(self.lengths) or not self.lengths[flat].all()):
            raise ValueError("an identifier is not in the vocabulary")
        sizes = self.lengths[flat]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.data[np.repeat(self.starts[flat] - (ends - sizes), sizes) + np.arange(total)]


def of_file(kind: type, *args):
    """An encoder or decoder of a file, built once in each Python worker."""
    if (kind, *args) not in _models:
        _models.clear()
        _models[kind, *args] = kind(*args)
    return _models[kind, *args]


def _read(docs: DataFrame, ranks: str):
    with open(ranks, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` for each row: every match of ``pattern`` merged by ``ranks``.

    ``ranks`` is the path of a rank file on the driver (base64 token and rank on each line); its bytes, about a
    MB whatever the input, go to the workers with the job. A null or empty text has no
    identifiers; repeated rows are encoded each; a null id stays null; other columns are ignored
    whatever their names; an empty table gives an empty result. No shuffle.
    """
    file = _read(docs, ranks)

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        some = of_file(Encoder, file.value, pattern).encode(texts(block.column(1)))
        flat = np.frombuffer(b"".join(some), np.int32)
        offsets = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in some])]).astype(np.int32)
        return batch(["doc_id", "ids"], [block.column(0), pa.ListArray.from_arrays(offsets, flat)])

    kind = dict(docs.dtypes)[id_col]
    # Larger blocks share more repeated words.
    rows = narrow(docs, doc_id=id_col, text=text_col)
    return map_blocks(rows, work, f"doc_id {kind}, ids array<int>", 3 << 20)


def decode(encoded: DataFrame, ranks: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, ids, decoded binary``: the bytes of each list of identifiers, a null list being empty.

    The bytes are those of the text for what ``encode`` made. An identifier outside the vocabulary is an error.
    """
    file = _read(encoded, ranks)

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        column = block.column(1)
        counts = np.array(pc.fill_null(pc.list_value_length(column), 0), np.int64)
        flat = np.asarray(column.flatten())
        model = of_file(Decoder, file.value)
        data = model.decode(flat)
        sizes = np.concatenate([[0], np.cumsum(model.lengths[flat])])
        offsets = sizes[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
        made = pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])
        return batch(["doc_id", "ids", "decoded"], [block.column(0), column, made])

    kind = dict(encoded.dtypes)[id_col]
    rows = narrow(encoded, doc_id=id_col, ids=ids_col).withColumn("ids", F.col("ids").cast("array<int>"))
    return map_blocks(rows, work, f"doc_id {kind}, ids array<int>, decoded binary")

"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a piece form a doubly linked list, and its adjacent pairs that can merge wait in a
heap ordered by rank, then place. Popping the lowest pair, unlinking its right symbol and
pushing the two new neighbours costs O(log n) a merge. Every merge removes one symbol, so
the count is the initial symbols minus the merges; identifiers are never put together.
"""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from shopstream.llm.arrow import batch, map_blocks, narrow, texts
from shopstream.llm.pretokens import Memory, Pieces

# Fixed value: the split that byte-level pre-tokenizers of this file format apply.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_models: dict[bytes, Counter] = {}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    symbol = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [symbol[b] for b in range(256)]


def merges(symbols: list[int], pairs: dict[int, int], made: list[int] | range) -> list[int]:
    """Merge lowest rank first, leftmost among equals, and give the list with -1 for symbols merged away.

    ``pairs`` maps ``left << 32 | right`` to a rank, ``made`` a rank to the merged symbol. The heap
    holds ``rank * n + place``; an entry is stale if the pair now at its place has another rank.
    """
    symbols, n, rank_of = list(symbols), len(symbols), pairs.get
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    ranks = [rank_of(a << 32 | b, -1) for a, b in zip(symbols, symbols[1:])]
    ranks.append(-1)
    heap = [rank * n + i for i, rank in enumerate(ranks) if rank >= 0]
    heapify(heap)
    while heap:
        rank, i = divmod(heappop(heap), n)
        if ranks[i] != rank:
            continue
        gone = right[i]
        new = symbols[i] = made[rank]
        symbols[gone] = ranks[gone] = ranks[i] = -1
        after = right[i] = right[gone]
        if after < n:
            left[after] = i
            rank = ranks[i] = rank_of(new << 32 | symbols[after], -1)
            if rank >= 0:
                heappush(heap, rank * n + i)
        before = left[i]
        if before >= 0:
            rank = ranks[before] = rank_of(symbols[before] << 32 | new, -1)
            if rank >= 0:
                heappush(heap, rank * n + before)
    return symbols


class Counter:
    """Counts by a byte-level BPE file; added tokens in a text count one each, as by default."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        plain = (
            model.get("type") == "BPE"
            and not model.get("dropout")
            and not model.get("ignore_merges")
            and not model.get("continuing_subword_prefix")
            and not model.get("end_of_word_suffix")
            and spec["normalizer"] is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        )
        if not plain:
            raise ValueError("only plain byte-level BPE files are supported")
        vocab = model["vocab"]
        self.bytes = [vocab[s] for s in byte_symbols()]
        self.pairs, self.made = {}, []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[vocab[a] << 32 | vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.added = [t["content"] for t in spec["added_tokens"] if t["content"]]
        self.pieces = Pieces(BYTE_LEVEL)
        self.by_piece = Memory(self.count_piece, 400_000)
        self.by_word = Memory(self.count_word, 250_000)

    def count_piece(self, piece: str) -> int:
        symbols = [self.bytes[b] for b in piece.encode()]
        if len(symbols) == 1:
            return 1
        merged = merges(symbols, self.pairs, self.made).count(-1)
        return len(symbols) - merged

    def count_word(self, word: str) -> int:
        return sum(map(self.by_piece.__getitem__, self.pieces.word(word)))

    def count(self, text: str) -> int:
        total = 0
        for part in self.outside(text):
            if part is None:
                total += 1
            elif part:
                pieces, words = self.pieces.words(part)
                total += sum(map(self.by_piece.__getitem__, pieces)) + sum(map(self.by_word.__getitem__, words))
        return total

    def outside(self, text: str) -> list[str | None]:
        """The text cut at added tokens (None); the leftmost, then the longest, wins."""
        if not any(t in text for t in self.added):
            return [text]
        parts, at = [], 0
        while True:
            hits = [(text.find(t, at), -len(t), t) for t in self.added]
            found = min((h for h in hits if h[0] >= 0), default=None)
            if found is None:
                return [*parts, text[at:]]
            parts += [text[at : found[0]], None]
            at = found[0] + len(found[2])


def counter(file: bytes) -> Counter:
    """The counter of a file, read once in each Python worker."""
    if file not in _models:
        _models.clear()
        _models[file] = Counter(file)
    return _models[file]


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``tokenizer`` is the path of a byte-level BPE file on the driver; its bytes, a few MB whatever
    the input, go to the workers with the job. A null text counts as empty: 0 bytes, 0
    tokens. A null id stays null; repeated rows are counted each; other columns are
    ignored whatever their names; an empty table gives an empty result. Very long
    pieces cost O(n log n). No shuffle.
    """
    with open(tokenizer, "rb") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())
    counter(file.value)  # fail here, not in a task, if the file is not supported

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        model = counter(file.value)
        found = texts(block.column(1))
        tokens = [model.count(t) for t in found]
        return batch(
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            [
                block.column(0),
                pa.array([len(t.encode()) for t in found], pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_()),
            ],
        )

    kind = dict(docs.dtypes)[id_col]
    rows = narrow(docs, doc_id=id_col, text=text_col)
    return map_blocks(rows, work, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")

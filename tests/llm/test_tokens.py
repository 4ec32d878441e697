"""Token counts and the byte-level codec against the libraries whose results they give."""

from __future__ import annotations

import base64
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shopstream.llm import bpe_codec, token_count
from shopstream.llm.pretokens import Memory
from tests.llm.helpers import AWKWARD, docs

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = Tokenizer.from_file(JSON)
COUNTER = token_count.Counter(open(JSON, "rb").read())
ENCODER = bpe_codec.Encoder(open(RANKS, "rb").read(), P.PATTERN)
DECODER = bpe_codec.Decoder(open(RANKS, "rb").read())
PLAIN = tiktoken.Encoding(
    "own",
    pat_str=P.PATTERN,
    mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))},
    special_tokens={},
)
ODD = st.text(st.sampled_from(list("ab E's'll12\n\t \x1c\x85\u3000é漢🙂.!-_=")) | st.characters(exclude_categories=["Cs", "Cn"]), max_size=60)


def library_count(text: str) -> int:
    return len(TOKENIZER.encode(text, add_special_tokens=False).ids)


def ids(text: str) -> list[int]:
    return np.frombuffer(ENCODER.encode([text])[0], np.int32).tolist()


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_any_text(text):
    assert COUNTER.count(text) == library_count(text)
    assert ids(text) == PLAIN.encode_ordinary(text)
    assert DECODER.decode(np.array(ids(text), np.int32)).tobytes() == text.encode()


@pytest.mark.parametrize(
    "text",
    [
        "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "a  b\n c \n\n d ", " lead", "trail ",
        "x" * 3000, "=-" * 500, "ab" * 70, "".join(random.Random(3).choice("abcdefgh") for _ in range(2000)),
    ],
)
def test_special_and_long_pieces(text):
    assert COUNTER.count(text) == library_count(text)
    assert ids(text) == PLAIN.encode_ordinary(text)


def test_tables(spark):
    table = docs(spark, AWKWARD)
    rows = token_count.token_counts(table, JSON, limit=100).collect()
    want = [(i, len((t or "").encode()), library_count(t or ""), library_count(t or "") > 100) for i, t in AWKWARD]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)

    decoded = bpe_codec.decode(bpe_codec.encode(table, RANKS, P.PATTERN), RANKS).collect()
    want = [(i, PLAIN.encode_ordinary(t or ""), (t or "").encode()) for i, t in AWKWARD]
    assert sorted([(r.doc_id, r.ids, bytes(r.decoded)) for r in decoded], key=str) == sorted(want, key=str)


def test_empty_table(spark):
    none = docs(spark, [])
    assert token_count.token_counts(none, JSON).count() == 0
    assert bpe_codec.decode(bpe_codec.encode(none, RANKS, P.PATTERN), RANKS).count() == 0


def test_unknown_identifier():
    with pytest.raises(ValueError):
        DECODER.decode(np.array([10**6], np.int32))


def test_unsupported_file():
    with pytest.raises(ValueError):
        token_count.Counter(open(P.path("word_bpe_49k.json"), "rb").read())


def test_memory_is_bounded():
    made = []
    memory = Memory(lambda key: made.append(key) or len(key), size=10)
    for i in range(1000):
        assert memory[str(i)] == len(str(i))
        assert len(memory) + len(memory.old) <= 20
    assert memory["999"] == 3 and made.count("999") == 1
    assert memory["y" * 100] == 100 and "y" * 100 not in memory


def test_results_do_not_depend_on_what_was_seen():
    words = [f"{a}{b}{c}" for a in "xyz" for b in "pq" for c in range(200)]
    small = bpe_codec.Encoder(open(RANKS, "rb").read(), P.PATTERN)
    small.by_piece, small.by_word = Memory(size=7), Memory(size=5)
    for i in range(0, len(words), 50):
        text = " ".join(words[i : i + 60])
        assert np.frombuffer(small.encode([text])[0], np.int32).tolist() == PLAIN.encode_ordinary(text)

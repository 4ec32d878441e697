"""Letter runs of whole blocks of texts: the terms that word statistics count.

A term is a longest run of the letters A-Z, a-z and of characters beyond ASCII; A-Z count as a-z.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from shopstream.llm.words import Words, raw, words

_SPACE = 32
# Every byte that is no letter becomes a space; A-Z become a-z.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[128:] = True
_TO = np.where(_LETTER[_LOWER], _LOWER, np.uint8(_SPACE)).astype(np.uint8)


def letter_words(column: pa.Array) -> Words:
    """Terms of each text as byte places and 64-bit hashes; ``data`` has the letters in lower case, all else as spaces."""
    data, start = raw(column)
    clean = pa.py_buffer(_TO[data])
    return words(pa.StringArray.from_buffers(len(column), pa.py_buffer(start.astype(np.int32)), clean))


def terms(w: Words) -> pa.StringArray:
    """The terms themselves, one after the other."""
    starts = np.concatenate([[0], np.cumsum(w.end - w.start)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(w.start), pa.py_buffer(starts), pa.py_buffer(w.data[w.data != _SPACE]))

"""Secret scan: an Aho-Corasick keyword prefilter, regular expressions anchored at the hits, checksums.

One pass of an automaton over the text, lower-cased in ASCII only so that places stay the same, finds
every keyword that a secret can start with. A regular expression is tried at these places and
nowhere else. Long hex runs have no keyword; every eighth character is looked at instead, as a run of
32 must show four of its own in a row. Tokens of two public formats carry a CRC-32 of their
random part, so a hit is accepted only if the check digits agree.
"""

from __future__ import annotations

import re
import zlib
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.arrow import batch, map_blocks, narrow, texts

# Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "checked")
BASE = KINDS[:3]

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
SAMPLED_HEX = re.compile(r"[0-9a-f]{4,}")
# Prefixes, lengths and check digits of two public token formats (a CRC-32 of the random
# part in six base-62 digits).
CHECKED = re.compile(r"(?:ghp|gho|ghu|ghs|ghr|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "checked": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
}
HEX_CHARS = frozenset("0123456789abcdef")

SPANS = "array<struct<kind:string,start:int,end:int>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


@cache
def automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            made.add_word(word, (kind, len(word)))
    made.make_automaton()
    return made


def check_digits(body: str) -> str:
    """CRC-32 of a token's random part as six base-62 digits."""
    left, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        left, digit = divmod(left, 62)
        out = DIGITS[digit] + out
    return out


def find_assign(text: str, at: int) -> tuple[int, bool]:
    """(end of the match at this place or -1, whether it counts); likewise below."""
    found = ASSIGN.match(text, at)
    return (found.end(), len(found[2]) >= 8) if found else (-1, False)


def find_access(text: str, at: int) -> tuple[int, bool]:
    found = ACCESS.match(text, at)
    return (found.end(), found.end() - at >= 16) if found else (-1, False)


def find_checked(text: str, at: int) -> tuple[int, bool]:
    found = CHECKED.match(text, at)
    return (found.end(), check_digits(found[1]) == found[2]) if found else (-1, False)


FINDERS = {"assign": find_assign, "access": find_access, "checked": find_checked}


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of each secret by start, then kind as listed; the end is exclusive.

    Of one kind, matches are the leftmost that do not overlap, whether they count or not.
    """
    found, over = [], dict.fromkeys(FINDERS, 0)
    lowered = text.encode().lower().decode()
    for last, (kind, length) in automaton().iter(lowered):
        start = last + 1 - length
        if start >= over[kind]:
            end, counts = FINDERS[kind](text, start)
            if end >= 0:
                over[kind] = end
            if counts:
                found.append((kind, start, end))
    found += [("hex", start, end) for start, end in hex_runs(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def hex_runs(text: str, least: int = 32, step: int = 8) -> list[tuple[int, int]]:
    """Maximal runs of lower-case hex digits of ``least`` characters or more (at least 4 steps)."""
    found, over = [], 0
    for hit in SAMPLED_HEX.finditer(text[::step]):
        # A stretch of sampled digits may span several runs, each with four samples or more.
        at, last = hit.start() * step, (hit.end() - 1) * step
        while at <= last:
            if at < over:
                at += step
                continue
            start = at
            while start > over and text[start - 1] in HEX_CHARS:
                start -= 1
            end = HEX.match(text, start).end()
            if end - start >= least:
                found.append((start, end))
            over = end
            at += max(step, (end - at + step - 1) // step * step)
    return found


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans array<struct<kind, start, end>>`` for each row, in code points.

    A null or empty text has no spans. Every row is scanned whole, repeated rows each; a null id stays null;
    other columns are ignored whatever their names; an empty table gives an empty result. No shuffle.
    """

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        some = [
            [{"kind": k, "start": a, "end": b} for k, a, b in spans(t)] for t in texts(block.column(1))
        ]
        return batch(["doc_id", "spans"], [block.column(0), pa.array(some, SPAN_TYPE)])

    kind = dict(docs.dtypes)[id_col]
    return map_blocks(narrow(docs, doc_id=id_col, text=text_col), work, f"doc_id {kind}, spans {SPANS}")


def redact(docs: DataFrame, mask: str = "[secret]", text_col: str = "text") -> DataFrame:
    """The same rows and columns with each secret in the text replaced by ``mask``; spans that touch share one.

    A null text stays null. No shuffle.
    """
    names = docs.columns
    at = names.index(text_col)

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        arrays = list(block.columns)
        arrays[at] = pa.array([masked(t, mask) for t in block.column(at).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays(arrays, names=list(block.schema.names))

    return map_blocks(docs, work, docs.schema)


def masked(text: str | None, mask: str) -> str | None:
    if not text:
        return text
    out, over = [], 0
    for _, start, end in spans(text):
        if start >= over:
            out += [text[over:start], mask]
        over = max(over, end)
    return "".join([*out, text[over:]])


def listed(spans_col: str, kinds: tuple[str, ...]):
    """Column: ``kind:start:end`` of the spans of these kinds, joined by commas."""
    kept = F.filter(spans_col, lambda s: s["kind"].isin(*kinds))
    shown = F.transform(
        kept, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(shown, ",")

"""Divergence of sources beside a direct computation over all copies and all kept terms."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from shopstream.llm import divergence

SCHEMA = "text string, lang string, source string, term string, n int, digest string, value string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    words = [[lower(w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)] for t, _, _ in rows]
    docs, sources = defaultdict(Counter), defaultdict(set)
    for (_, lang, source), found in zip(rows, words):
        docs[lang].update(set(found))
        sources[lang].add(source)
    out = []
    for lang in sources:
        kept = [t for t, n in docs[lang].items() if n >= least]
        counts = {s: Counter() for s in sources[lang]}
        for (_, of, source), found in zip(rows, words):
            if of == lang:
                counts[source].update(t for t in found if t in set(kept))
        counts[None] = sum(counts.values(), Counter())
        share = {
            s: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept} for s, c in counts.items()
        }
        for s in sources[lang]:
            pairs = [(-sum(abs(share[s][t] - share[o][t]) for t in kept), o) for o in sources[lang] if o != s]
            over = [(share[None][t] - share[s][t], t) for t in kept if counts[s][t] and share[s][t] > share[None][t]]
            for part, some in (("pair", sorted(pairs, key=key)), ("term", sorted(over, key=key)[:top])):
                out += [(lang, s, part, item, -v, i) for i, (v, item) in enumerate(some, 1)]
    return sorted(out)


def key(pair):
    return pair[0], pair[1].encode()


def found(spark, rows, **options):
    return sorted(tuple(r) for r in divergence.audit(table(spark, rows), **options).collect())


def sample(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "É", "naïve", "漢字", "x", "Yes", "no", "zeta", "a_b", "it's", "up2date"]
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["en", "fr"]), f"s{rng.randrange(7)}"
        k = int(source[1]) + 2
        rows.append((" ".join(rng.choice(words[: 2 * k]) for _ in range(rng.randrange(0, 30))), lang, source))
    # Copies inside a source, across sources and across languages.
    rows += [("the same text, of the same source", "en", f"s{i % 3}") for i in range(60)]
    rows += [("the same text, of the same source", "fr", "s1")] * 3
    return rows


@pytest.mark.parametrize("tile", [(2, 3), (32, 4096)])
def test_beside_a_direct_computation(spark, monkeypatch, tile):
    monkeypatch.setattr(divergence, "TILE_SOURCES", tile[0])
    monkeypatch.setattr(divergence, "TILE_TERMS", tile[1])
    rows = sample(1, 150)
    want = brute(rows, 4, 5)
    assert found(spark, rows, least=4, top=5) == want and len(want) > 100


def test_awkward_rows(spark):
    rows = [(None, None, None), ("", "", ""), ("a a", None, "s"), ("a", "", "t"), (None, "de", "s"), ("x", "de", "t"), ("é " * 40_000, "es", "s")]
    rows += [(None, "de", "u")] * 3
    for least in (1, 2, 99):
        assert found(spark, rows, least=least) == brute(rows, least, 50)
    assert found(spark, []) == []


def test_a_text_is_split_once_for_all_its_sources(spark):
    texts = divergence.collapsed(table(spark, [("a b a", "en", "s")] * 5 + [("a b a", "en", "t"), ("c", "en", "t")]))
    got = sorted((r.text, r.source, r.n) for r in texts.collect())
    assert got == [("a b a", "s", 5), ("a b a", "t", 1), ("c", "t", 1)]
    block = pa.RecordBatch.from_pylist(
        [{"lang": "en", "digest": b"1", "text": "a b a", "source": s, "n": n} for s, n in (("s", 5), ("t", 1))],
        pa.schema([("lang", pa.string()), ("digest", pa.binary()), ("text", pa.string()), ("source", pa.string()), ("n", pa.int64())]),
    )
    cells = {(r["source"], r["term"]): (r["n"], r["docs"]) for r in divergence.cells(block).to_pylist()}
    assert cells == {("s", "a"): (10, 5), ("s", "b"): (5, 5), ("t", "a"): (2, 1), ("t", "b"): (1, 1)}
    twice = divergence.summed([divergence.cells(block)] * 2)
    assert sorted(twice["n"].to_pylist()) == [2, 4, 10, 20]

"""Nearest neighbours against all products."""

from __future__ import annotations

import numpy as np
import pytest

from shopstream.llm import nearest
from shopstream.llm.nearest import search

SCHEMA = "vec_id bigint, embedding array<float>, label int, list int, score double"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 2.0) for i, v in rows], SCHEMA)


def brute(rows, every, k):
    dims = [len(v) for _, v in rows if usable(v)]
    dim = min(set(dims), key=lambda d: (-dims.count(d), d)) if dims else 0
    good = sorted({(i, tuple(np.float32(v).astype(float))) for i, v in rows if i is not None and usable(v) and len(v) == dim})
    out = {}
    for q, x in good:
        if q % every == 0:
            near = sorted((-float(np.dot(x, y)), i) for i, y in good if i != q)[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def usable(v):
    return v is not None and len(v) > 0 and None not in list(v) and bool(np.isfinite(np.array(v, float)).all()) and bool(np.any(np.array(v, float)))


def found(spark, rows, **kw):
    out = {}
    for r in search(table(spark, rows), "id % 5 = 0", k=10, **kw).orderBy("query_id", "rank").collect():
        got = out.setdefault(r.query_id, [])
        assert r.rank == len(got) + 1
        got.append((r.vec_id, r.score))
    return out


def same(got, want):
    assert set(got) == {q for q, near in want.items() if near}
    for q, near in got.items():
        assert [s for _, s in near] == pytest.approx([s for _, s in want[q]], abs=1e-6)
        assert [i for i, _ in near] == [i for i, _ in want[q]]


@pytest.mark.parametrize("scale", [0, 1])
def test_all_lists_probed_is_exact(spark, scale, monkeypatch):
    monkeypatch.setattr(nearest, "SURE", 50.0)
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, 24)) * np.exp(scale * rng.standard_normal((400, 1)))
    rows = list(enumerate(x.round(3)))
    same(found(spark, rows, probe_share=1.0), brute(rows, 5, 10))


def test_recall_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SHARD_VECTORS", 100)
    monkeypatch.setattr(nearest, "CHUNK_QUERIES", 50)
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((12, 32))
    rows = list(enumerate((centre[rng.integers(0, 12, 1500)] + 0.6 * rng.standard_normal((1500, 32))).round(3)))
    got, want = found(spark, rows), brute(rows, 5, 10)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert set(got) == set(want) and hits >= 0.9 * 10 * len(want)


def test_awkward_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(rng.integers(-2, 3, (60, 6)))]
    rows += [(100 + i, rows[7][1]) for i in range(40)]  # one vector many times, queries among them
    rows += [(200, None), (205, []), (210, [0.0] * 6), (215, [1, None, 1, 1, 1, 1]), (220, [1, float("nan"), 1, 1, 1, 1])]
    rows += [(225, [1, float("inf"), 1, 1, 1, 1]), (230, [1.0, 2.0]), (None, rows[3][1]), rows[5], rows[5]]
    same(found(spark, rows, probe_share=1.0), brute(rows, 5, 10))


def test_few_rows(spark):
    assert found(spark, []) == {}
    assert found(spark, [(5, [1.0, 2.0])]) == {}
    rows = [(5, [1.0, 2.0]), (6, [3.0, -1.0]), (10, [-1.0, -1.0])]
    same(found(spark, rows), brute(rows, 5, 10))

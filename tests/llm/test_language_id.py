"""Language identification on invented languages with known mixtures."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from shopstream.llm.language_id import fit, identify, trigrams
from tests.llm.helpers import AWKWARD, docs

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ver", "ich"], "cc": ["é", "eau", "tion", "que"]}


def text(lang, seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def model(spark, langs=SYLLABLES):
    rows = [(i, text(lang, i), lang) for i, lang in enumerate(list(langs) * 15)] + [(99, None, "aa"), (98, "zz zz", None)]
    return fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))


def test_trigrams_stay_inside_texts():
    bins, owner = trigrams(pa.array(["ab", None, "", "ABé"]))
    assert np.bincount(owner, minlength=4).tolist() == [2, 0, 0, 4]
    assert bins[owner == 0][0] == bins[owner == 3][0]
    sliced, _ = trigrams(pa.array(["xyz", "ab"]).slice(1))
    assert sliced.tolist() == bins[owner == 0].tolist()


def test_pure_and_mixed(spark):
    rows = [(i, text(lang, 500 + i)) for i, lang in enumerate(list(SYLLABLES) * 20)]
    mixed = [(100, text("aa", 1, 70) + " " + text("bb", 2, 30)), (101, text("cc", 3, 50) + " " + text("aa", 4, 30) + " " + text("bb", 5, 30))]
    found = {r.doc_id: r for r in identify(docs(spark, rows + mixed), model(spark)).collect()}
    assert all(found[i].lang_pred == lang for i, lang in enumerate(list(SYLLABLES) * 20))
    assert sum(len(found[i].languages) == 1 for i, _ in rows) >= 55
    assert [x.lang for x in found[100].languages] == ["aa", "bb"] and found[101].lang_pred == "cc"
    assert {x.lang for x in found[101].languages} == set(SYLLABLES)
    for r in found.values():
        assert r.score == r.languages[0].share and abs(sum(x.share for x in r.languages) - 1) < 1e-3


def test_awkward_rows(spark):
    rows = [*AWKWARD, (20, "1234 !!"), (21, "é"), (22, "k")]
    found = identify(docs(spark, rows), model(spark)).collect()
    assert len(found) == len(rows)
    und = {r.doc_id for r in found if r.lang_pred == "und"}
    assert und == {1, 2, 3, 20} and all(r.score == 0 and r.languages == [] for r in found if r.doc_id in und)
    assert all(0 < r.score <= 1 for r in found if r.doc_id not in und)
    assert identify(docs(spark, []), model(spark)).count() == 0


def test_without_labels(spark):
    none = fit(spark.createDataFrame([], "doc_id bigint, text string, lang string"))
    assert none[0] == [] and {r.lang_pred for r in identify(docs(spark, AWKWARD), none).collect()} == {"und"}
    one = fit(spark.createDataFrame([(1, "abc", "aa")], "doc_id bigint, text string, lang string"))
    assert {r.lang_pred for r in identify(docs(spark, [(1, "xyz")]), one).collect()} == {"aa"}

"""The secret scan against regular expressions tried everywhere."""

from __future__ import annotations

import random
import re

from shopstream.llm.secret_scan import check_digits, masked, redact, scan, spans
from tests.llm.helpers import AWKWARD, docs

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
POOL = [
    "password", "Passwd", "SECRET", "token", "api_key", "apikey", "'", '"', " ", "  ", ":", "=", "AKIA", "AKIAAKIA", "ABCDEFGHIJKLMNOP",
    "0123456789abcdef", "0123456789abcdef" * 2, "g", "é", "İ", "ſ", "\u212a", "abc.", "/+-_", "\n", "deadbeef" * 5, "ghp_",
]


def brute(text: str):
    found = [("assign", m.start(), m.end()) for m in re.finditer(ASSIGN, text, re.A | re.I) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_base_kinds_match_brute_force():
    rng = random.Random(4)
    for _ in range(20_000):
        text = "".join(rng.choice(POOL) for _ in range(rng.randrange(14)))
        assert [s for s in spans(text) if s[0] != "checked"] == brute(text)


def test_check_digits_decide():
    body = "Ab3" * 10
    good = "ghp_" + body + check_digits(body)
    assert spans(f"x {good}.") == [("checked", 2, 42)]
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    assert spans(f"x {bad}.") == []
    assert spans(f"x {good}Z") == []


def test_redaction():
    assert masked("é password = hunter2hunter2 end", "[s]") == "é [s] end"
    assert masked("token: " + "a" * 40, "[s]") == "[s]"
    assert masked(None, "[s]") is None and masked("", "[s]") == ""


def test_tables(spark):
    rows = [*AWKWARD, (10, "token=abcdefgh1"), (11, "f" * 100_000)]
    table = docs(spark, rows)
    found = {(r.doc_id, tuple(tuple(s) for s in r.spans)) for r in scan(table).collect()}
    assert found == {(i, tuple(brute(t or ""))) for i, t in rows}
    clean = redact(table)
    assert clean.columns == table.columns and clean.count() == len(rows)
    assert scan(clean).filter("size(spans) > 0").count() == 0
    assert scan(docs(spark, [])).count() == redact(docs(spark, [])).count() == 0

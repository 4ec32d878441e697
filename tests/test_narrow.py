"""What is shuffled and staged for gold holds no column that gold does not read."""

from __future__ import annotations

import os

import pytest

from shopstream.plans import customer

from tests.conftest import TESTDATA

from workload import queries


@pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")
def test_staged_orders_hold_neither_id_nor_lineage(spark):
    columns = set(queries.orders_clean(spark, TESTDATA).columns)
    assert not columns & {"event_id", "ingestion_timestamp", "source_file"}
    assert {"category_id", "category_code", "brand", "price", "user_session", "event_hour"} <= columns


def test_rows_of_sessions_and_products_carry_no_amounts_or_times(silver):
    rows = customer.ACTIVITY.make(silver).collect()
    wide = ("views", "removes", "paid_units", "paid_max", "t_min", "t_max")
    for kind in ("session", "product"):
        some = [r for r in rows if r._entity == kind]
        assert some and all(r[c] is None for r in some for c in wide)
    days = [r for r in rows if r._entity == "date"]
    assert sum(r.n for r in days) == silver.count() and all(r.t_min is not None for r in days)

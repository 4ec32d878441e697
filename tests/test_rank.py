from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopstream.operators import rank
from tests.conftest import rows_of

ROW = st.tuples(st.sampled_from([None, "a", "b"]), st.integers(0, 60) | st.integers(0, 1 << 40))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=60))
def test_ranks_equal_the_window_functions(spark, rows):
    df = spark.createDataFrame(rows, "g string, v bigint").withColumn("id", F.monotonically_increasing_id())
    old, (rank.FINE_BITS, rank.COARSE_BITS) = (rank.FINE_BITS, rank.COARSE_BITS), (2, 5)
    try:
        for by in ([], ["g"]):
            table = rank.rank_table(df, "v", by, "r", "p")
            got = rank.attach_rank(df, table, "v", by)
            up, down = Window.partitionBy(*by).orderBy("v"), Window.partitionBy(*by).orderBy(F.desc("v"))
            want = df.withColumns({"r": F.dense_rank().over(down), "p": F.percent_rank().over(up)})
            assert rows_of(got, "id", "r", "p") == rows_of(want, "id", "r", "p")
    finally:
        rank.FINE_BITS, rank.COARSE_BITS = old


def test_one_row(spark):
    df = spark.createDataFrame([(5,)], "v bigint")
    assert tuple(rank.rank_table(df, "v", [], "r", "p").first()) == (5, 1, 0.0)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_equal_values_collapse_before_any_window(spark, by):
    """A value shared by all rows reaches the window as one row."""
    df = spark.range(5000).select(F.lit("a").alias("g"), F.lit(7).cast("bigint").alias("v"))
    plan = rank.rank_table(df, "v", by, "r")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Aggregate")
    assert rank.rank_table(df, "v", by, "r").count() == 1

"""shopstream: clickstream analytics as composable PySpark DataFrame operators.

Layers (each a pure function from DataFrame to DataFrame):

* ``sources``    files, tables and adapters that yield raw or bronze events
* ``operators``  bronze / silver shaping, quality rules, merge, security, upkeep
* ``plans``      gold tables, report queries and the table graph
* ``streaming``  the same transformations on unbounded input
* ``functions``  column-level helpers (rates, money, masks)
"""

from shopstream.session import get_spark

__all__ = ["get_spark"]

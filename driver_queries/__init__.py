"""The library's operators run on the driver's tables, each with its SQL twin.

The tables stand in for the raw datasets; ``stand_ins`` gives them their shape.
"""

from __future__ import annotations

from driver_queries import loads, relational, scalar, star, storage

QUERIES: dict = {}
SQL: dict = {}
for _module in (scalar, relational, storage, loads, star):
    QUERIES.update(_module.QUERIES)
    SQL.update(_module.SQL)

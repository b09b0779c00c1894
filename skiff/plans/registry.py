"""All contract queries and their DuckDB twins, by name."""

from __future__ import annotations

from skiff.plans import aqi, oracle_aqi, oracle_retail, oracle_trips, retail, trips

QUERIES = {}
QUERIES.update(retail.QUERIES)
QUERIES.update(trips.QUERIES)
QUERIES.update(aqi.QUERIES)

ORACLES = {}
ORACLES.update(oracle_retail.ORACLES)
ORACLES.update(oracle_trips.ORACLES)
ORACLES.update(oracle_aqi.ORACLES)

# Every oracle must belong to a registered query.
assert set(ORACLES) <= set(QUERIES), set(ORACLES) - set(QUERIES)

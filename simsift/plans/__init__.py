"""Named queries over the driver test tables (Spark builders + DuckDB oracle SQL)."""

from simsift.plans import search_queries, feature_queries, ingest_queries, chunk_queries, index_queries, point_queries  # noqa: F401,E501
from simsift.plans import cell_queries, store_queries  # noqa: F401
from simsift.plans.registry import ORACLE, QUERIES  # noqa: F401

"""Every operator as a query over the test tables, with its SQL equivalent."""

from fallowlens.catalog import features, mosaics, points, rasters, survey, tables  # noqa: F401
from fallowlens.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]

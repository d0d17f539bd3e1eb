"""Every operator as a query on the test tables, with an independent SQL oracle."""

from salesflow.catalog.base import ORACLES, QUERIES
from salesflow.catalog import (  # noqa: F401  (each registers its queries)
    scans, scalars, aggregations, serving, streams, quality, prediction, flows, lake, fits)

__all__ = ["QUERIES", "ORACLES"]

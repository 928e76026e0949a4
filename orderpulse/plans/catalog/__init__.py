"""Every query with the SQL it is checked against."""

from orderpulse.plans.catalog import (files, insight, metrics, parsing, reports, running,
                                      scalars, serving, sketches, sources, streams, windows)
from orderpulse.plans.catalog.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "files", "insight", "metrics", "parsing", "reports",
           "running", "scalars", "serving", "sketches", "sources", "streams", "windows"]

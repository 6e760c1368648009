"""The query catalog: every operator run on the given tables.

Importing this package registers all queries in ``registry.CATALOG``.
"""

from footfall.plans import (  # noqa: F401
    aggregates,
    etl,
    joins,
    kpis,
    layout,
    orders,
    projections,
    scalars,
    scans,
    sinks,
    streams,
    windows,
)
from footfall.plans.registry import CATALOG  # noqa: F401

"""Registered queries over the test tables, each with the SQL it must agree with."""

from tallyhouse.queries import (  # noqa: F401  (importing a module registers its queries)
    aggregations,
    chains,
    expressions,
    inputs,
    jobs,
    joins,
    ordering,
    projections,
)
from tallyhouse.queries.registry import ORACLES, QUERIES  # noqa: F401

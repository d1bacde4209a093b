"""The driver's queries, each beside the SQL that must give the same rows."""

from tillcast.queries import (  # noqa: F401  (each module registers its queries)
    candidates,
    cleaning,
    evaluation,
    histories,
    modelling,
    periods,
    profiling,
    streams,
)
from tillcast.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

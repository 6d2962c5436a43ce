"""Query plans over the shared tables: each key = Spark query + optional oracle SQL."""

from tessera.plans import registry
from tessera.plans import certified, features, iterative, ml, relational, sources, stats, streaming, text  # noqa: F401  (register keys)

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES

"""Registered queries over the supplied tables, each with its SQL check where SQL can say it."""

from kinfold.catalog import building, filed, filtering, finding, profiling, propagation, repair, staged

MODULES = (propagation, repair, building, filtering, profiling, finding, filed, staged)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}

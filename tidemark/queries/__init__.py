"""The operators as queries on the test tables, each with an equivalent SQL statement."""

from tidemark.queries import basics, events, history, loaders, privacy, setup, stored

_MODULES = (basics, loaders, history, events, setup, privacy, stored)

QUERIES = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}

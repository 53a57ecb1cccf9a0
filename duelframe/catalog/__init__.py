"""Registered queries over the given tables, one or more per operator."""

from duelframe.catalog import aggregates, joins, models, ordering, plans, scalars, sinks, sources, windows  # noqa: F401
from duelframe.catalog.base import ORACLES, QUERIES  # noqa: F401

"""Named example queries over the test tables, each with the SQL that states its result."""

from .registry import REGISTRY, oracles, query, runners  # noqa: F401
from . import counting, ingest, lookup, serving, streams, text  # noqa: F401  (fill the registry)

"""The registered queries: each a Spark callable with the SQL it must equal."""

from barloom.plans import analysis, charts, forecast, ingest, timing  # noqa: F401 (they register)
from barloom.plans.registry import oracles, queries

__all__ = ["oracles", "queries"]

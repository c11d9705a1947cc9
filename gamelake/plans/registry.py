"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with SQL for the same rows."""

from gamelake.plans import boards, columns, facts, ingest, live, models, series  # noqa: F401  they register their queries
from gamelake.plans.base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]

"""Registered queries bound to the driver tables, with their DuckDB twins.

Importing this package registers every query module.
"""

from lexgrid.plans import catalog, q_classify, q_entity, q_scoring, q_sequences, q_splits, q_text  # noqa: F401  (registration)
from lexgrid.plans.catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

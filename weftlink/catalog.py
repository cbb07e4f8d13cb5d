"""All registered queries of the library and their SQL oracles."""

from weftlink.plans.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

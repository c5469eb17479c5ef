"""DuckDB SQL for every named query, over the base tables only.

Common table expressions mirror the derived tables and the phases; each query ends in a
select from them.
"""

from oracles.build import ORACLES

__all__ = ["ORACLES"]

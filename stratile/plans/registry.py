"""Name -> query and name -> oracle SQL of the spatial tile operators."""

from __future__ import annotations

from . import geodesy, grids, indexes, meshes, texts, trees

_PLANS = (trees, grids, texts, geodesy, meshes, indexes)

QUERIES = {name: query for plan in _PLANS for name, query in plan.QUERIES.items()}
ORACLE_SQL = {name: sql for plan in _PLANS for name, sql in plan.ORACLE_SQL.items()}

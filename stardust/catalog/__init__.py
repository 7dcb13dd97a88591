"""Query catalog: every registered query (a Spark plan over the driver's tables)
and, where SQL can express it, the equivalent DuckDB text used as an oracle.

"""

from __future__ import annotations

from ._registry import ORACLE, QUERIES, register  # noqa: F401
from . import q_sources, q_functions, q_quality, q_aggregates, q_star, q_store, q_changes, q_runs, q_edges  # noqa: F401,E402

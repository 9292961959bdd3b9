"""All registered queries over the given tables and their SQL oracles."""

from cinderlane.plans import arena_queries, definition_queries, evaluation_queries, frame_queries, label_queries, ledger_queries, record_queries, replay_queries  # noqa: F401  register their queries
from cinderlane.plans.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]

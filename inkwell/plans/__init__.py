"""Plans of the registered queries; importing the modules registers them."""

from inkwell.plans import audit_queries, catalog_queries, decision_queries, dedup_queries, encoding_queries, heading_queries, kernel_queries, line_queries, metadata_queries, pattern_queries, review_queries, sequence_queries, text_queries  # noqa: F401
from inkwell.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]

"""Imports every module that registers queries."""

from __future__ import annotations

from evidar.plans import audit_queries, claims_queries, evidence_queries, lexicon_queries, market_queries, match_queries, model_queries, nested_queries, operator_queries, price_queries, review_queries, trust_queries  # noqa: F401
from evidar.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]

"""All snapshot queries."""

from tidemark.plans import dashboard_jobs, entity_jobs, layer_jobs, market_jobs, pack_jobs, page_jobs, queue_jobs, report_jobs, resume_jobs, stream_jobs  # noqa: F401
from tidemark.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]

"""strata: incremental, layered data processing on Spark.

Batch and streaming ingest of keyed, soft-deletable change batches, latest-row
dedup, newer-wins and SCD-1 upserts, a star schema with KPI queries, and fused
data-quality checks. Every operator is a DataFrame -> DataFrame function that
Catalyst plans; I/O lives in ``strata.sources`` and ``strata.plans``.
"""

from strata.session import configure, get_session, scratch_path

__all__ = ["configure", "get_session", "scratch_path"]

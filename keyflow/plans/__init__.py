"""Query registry: Spark queries over the test tables and their SQL oracles."""

from keyflow.plans.oracles import ORACLES
from keyflow.plans.queries import BATCH_QUERIES


def all_queries():
    """Batch queries plus the stream queries (imported lazily)."""
    from keyflow.plans.streams import STREAM_QUERIES
    return {**BATCH_QUERIES, **STREAM_QUERIES}


__all__ = ["ORACLES", "BATCH_QUERIES", "all_queries"]

"""All registered queries."""

from sparkcdc.plans import batch_queries, capture_queries, envelope_queries, log_queries, progress_queries, report_queries, stream_queries, text_queries  # noqa: F401
from sparkcdc.plans.registry import ORACLE, QUERIES  # noqa: F401

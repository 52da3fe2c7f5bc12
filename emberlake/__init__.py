"""emberlake: climate and fire-hotspot analytics on Spark DataFrames.

Batch document queries, satellite-pairing stream enrichment and report
feeds, all expressed as DataFrame / Structured Streaming plans.
"""

from emberlake.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]

"""shoplens: e-commerce behaviour analytics on Spark DataFrames.

Batch session analysis, per-area product ranking and an ad-click stream,
all expressed as DataFrame / Spark SQL / Structured Streaming plans.
"""

from shoplens.params import TaskParams
from shoplens.session import build_session, shared_root, scratch_path

__all__ = ["TaskParams", "build_session", "shared_root", "scratch_path"]

"""Click-stream rollups on Spark DataFrames and Structured Streaming."""

from clickroll.session import build_session, tune, work_dir

__all__ = ["build_session", "tune", "work_dir"]

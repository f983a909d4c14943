"""Transaction-risk analytics written as PySpark DataFrame operators."""

from riskweave.session import build_session, work_path

__all__ = ["build_session", "work_path"]

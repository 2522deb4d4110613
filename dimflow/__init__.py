"""dimflow: history-keeping star schemas as plain Spark DataFrame jobs."""

from dimflow.session import get_session, reliable_dir

__all__ = ["get_session", "reliable_dir"]

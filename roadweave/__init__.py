"""Linear-referencing, record-keeping and pavement analytics as native PySpark DataFrame functions."""

from roadweave.session import build_session, tune

__all__ = ["build_session", "tune"]

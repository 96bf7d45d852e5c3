"""Stereo-video survey analytics as plain Spark DataFrame jobs."""

from fathomframe.session import build_session, tune

__all__ = ["build_session", "tune"]

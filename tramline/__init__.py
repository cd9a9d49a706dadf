"""Public-transport delay analytics as plain Spark DataFrame functions."""

from tramline.session import build_session, prepare

__all__ = ["build_session", "prepare"]

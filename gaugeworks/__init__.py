"""Spark-native analytics over forecast evaluations and graded run records."""

from gaugeworks.session import build_session

__all__ = ["build_session"]

"""Spark-native engagement analytics: gates, silver, history, facts, ledgers."""

from tidemark.session import build_session

__all__ = ["build_session"]

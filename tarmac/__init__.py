"""Batch analytics for air-transport operations feeds, built on Spark DataFrames."""

from tarmac.session import build_session, prepare

__all__ = ["build_session", "prepare"]

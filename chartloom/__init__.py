"""Clinical-coding analytics as Spark DataFrame transformations."""

from chartloom.session import build_session

__all__ = ["build_session"]

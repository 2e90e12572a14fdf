"""Receivables-collections analytics expressed as Spark DataFrame transformations."""

from .session import get_session

__all__ = ["get_session"]

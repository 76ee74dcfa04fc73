"""Sinks: the path-backed medallion layers."""

from .store import Lakehouse

__all__ = ["Lakehouse"]

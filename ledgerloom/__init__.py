"""Retail order analytics as Spark DataFrame plans."""

from ledgerloom.config import RetailConfig

__all__ = ["RetailConfig"]

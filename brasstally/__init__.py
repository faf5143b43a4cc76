"""Billing and revenue data work as PySpark DataFrame operators."""

from brasstally.result import Result

__all__ = ["Result"]

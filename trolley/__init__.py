"""Analytics operators for user-item interaction logs, written as Spark DataFrame transformations."""

from trolley.columns import Columns

__all__ = ["Columns"]

"""Contract pricing for accommodation suppliers as Spark DataFrame jobs."""

from tariffloom.params import Stay

__all__ = ["Stay"]

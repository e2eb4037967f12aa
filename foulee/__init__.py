"""Activity and benefits analytics on Spark: DataFrame operators plus a batch and a streaming driver."""

from foulee.settings import Rules

__all__ = ["Rules"]

"""Identity and loan data sync, expressed as Spark DataFrame jobs."""

from tokenloom.settings import Settings

__all__ = ["Settings"]

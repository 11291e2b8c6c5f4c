"""Sales shortfall, funnel and recovery analytics as Spark DataFrame jobs."""

from weirline.settings import Settings

__all__ = ["Settings"]

"""lotweave: land-parcel analytics as PySpark DataFrame jobs."""

__all__ = ["functions", "operators", "plans", "sources"]

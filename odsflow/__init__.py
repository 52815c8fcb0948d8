"""Real-time operational data store and analytics, written as Spark jobs."""

__version__ = "0.1.0"

"""A PySpark engine for event-mixing background estimation."""

__version__ = "0.1.0"

"""ordwise: record generation, range-partitioned sorting and order validation on Spark."""

__version__ = "0.1.0"

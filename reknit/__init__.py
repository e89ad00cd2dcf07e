"""Table-to-table operators that merge, migrate, reconcile and enrich relational data on Spark."""

__version__ = "0.1.0"

"""Table and stream synchronisation as Spark DataFrame operations."""

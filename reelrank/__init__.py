"""Two-stage recommendation and watch-log analytics as PySpark jobs."""

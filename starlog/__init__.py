"""Activity-log and star-schema analytics written as PySpark DataFrame functions."""

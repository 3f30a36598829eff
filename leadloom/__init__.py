"""Contact and learning analytics as PySpark DataFrame functions."""

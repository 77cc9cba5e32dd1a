"""Customer-experience analytics as PySpark DataFrame operators."""

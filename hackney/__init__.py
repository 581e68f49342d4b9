"""Trip-record analytics as PySpark DataFrame operators."""

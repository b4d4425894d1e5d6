"""Filter expressions, metadata joins and measurement streams on Spark."""

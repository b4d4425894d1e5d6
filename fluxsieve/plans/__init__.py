"""From filter text to Spark columns: syntax, value types, binding."""

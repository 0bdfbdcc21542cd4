"""shapelog: a log analytics engine on PySpark."""

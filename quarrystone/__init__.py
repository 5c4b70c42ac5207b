"""Spark-native retail warehouse: text landing, staging, star schema, marts and data contracts."""

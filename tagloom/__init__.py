"""Spark-native batch engine for detection records extracted from engineering drawings."""

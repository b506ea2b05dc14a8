"""Retail analytics on Spark: validation, star schema, marts, measures, exports."""

"""Daily ad-metric tables on PySpark: scan, deduplicate, validate, upsert."""

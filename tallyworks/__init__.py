"""Trustworthy sales analytics on Spark: ingest, judge, load, report, reconcile."""

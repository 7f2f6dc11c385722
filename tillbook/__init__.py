"""Layered retail analytics on Spark: landing, staging, marts, reports and an incremental order feed."""

"""Spark-native curation of training data: ingest, dedup, verify, measure, split, export."""

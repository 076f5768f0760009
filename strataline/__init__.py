"""Spark-native snapshot analytics: typed ingest, quality gates, upserts, versioned dimensions, marts."""

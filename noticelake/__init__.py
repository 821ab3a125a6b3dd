"""Spark-native analytics over notice boards: snapshots, diffs, merges, enrichment and reporting views."""

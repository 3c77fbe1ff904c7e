"""Spark-native analytics for crawl corpora: extraction, frontiers, retry state and reports."""

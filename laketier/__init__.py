"""Spark-native medallion analytics: bronze ingest, silver upserts, quality gate, gold star schema."""

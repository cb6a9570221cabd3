"""Spark-native building blocks for layered (raw, cleaned, aggregated) tables fed by change messages."""

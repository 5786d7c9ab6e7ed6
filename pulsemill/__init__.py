"""Telemetry analytics on Spark: wide text reports in, typed samples and panel queries out."""

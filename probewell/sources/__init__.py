"""Readers and sinks of text formats; Parquet is the format between jobs."""

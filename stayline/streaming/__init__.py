"""Incremental ingest of new log files."""

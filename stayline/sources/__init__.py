"""Readers and writers, and adapters that yield the activity-log schema."""

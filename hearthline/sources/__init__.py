"""Readers and writers: JSON message files, CSV and batch-partitioned tables."""

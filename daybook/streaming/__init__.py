"""Micro-batch processing of arriving snapshots and change events."""

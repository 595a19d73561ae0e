"""Incremental snapshots; staging and capacity are the batch functions."""

"""Operators chained into pipelines."""

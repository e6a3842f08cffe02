"""Incremental forms of the batch models."""

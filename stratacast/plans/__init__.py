"""Composed models: silver, gold, serving slices and the two pipelines."""

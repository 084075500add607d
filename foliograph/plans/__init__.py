"""Composed pipelines, model adapters and the query catalogue."""

"""The published batch pipelines."""

"""Structured Streaming pipelines built from the same operators as the batch jobs."""

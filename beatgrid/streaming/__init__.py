"""Streaming use of the row-wise jobs."""

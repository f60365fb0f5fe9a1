"""Operators combined into the end-to-end jobs."""

"""Incremental runs over a growing corpus folder (Structured Streaming, availableNow trigger)."""

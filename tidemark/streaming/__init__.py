"""Structured Streaming forms of the ten-minute rollups."""

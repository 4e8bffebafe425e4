"""Structured Streaming jobs (STR-*, VER-08)."""

"""Scans, sinks and load jobs (SRC-*, LOAD-*)."""

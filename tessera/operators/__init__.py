"""Relational jobs as DataFrame -> DataFrame functions."""

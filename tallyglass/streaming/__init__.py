"""Incremental file intake."""

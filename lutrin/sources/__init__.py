"""Scans and file sinks."""

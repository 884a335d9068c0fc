"""Scans, archive expansion and sinks."""

"""Scans, sinks and per-stage measurements."""

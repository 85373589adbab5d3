"""Scans and sinks: trip files, station feeds, event streams and layered tables."""

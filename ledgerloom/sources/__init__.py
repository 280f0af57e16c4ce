"""Scans and sinks: delimited files, typed cells, uploads, seeds, committed tables."""

"""Scans and sinks; every schema is explicit."""

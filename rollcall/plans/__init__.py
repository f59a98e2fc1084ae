"""Whole jobs: scans, transforms, joins of checked size, written results."""

"""Scans of landed feeds and stored tables."""

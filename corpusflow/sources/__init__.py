"""Scans of landed responses and files, live fetching, table snapshots."""

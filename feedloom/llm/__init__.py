"""Operators for preparing training text: deduplication, packing, scoring, scans."""

"""Scans, streams and message decoding."""

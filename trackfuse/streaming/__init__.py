"""Sinks, triggers and table definitions."""

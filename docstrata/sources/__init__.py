"""Readers and the zone tables."""

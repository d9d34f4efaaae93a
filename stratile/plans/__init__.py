"""Registered query plans over the driver tables."""

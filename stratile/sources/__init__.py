"""Readers: tile folders, metadata, configuration, tile index documents."""

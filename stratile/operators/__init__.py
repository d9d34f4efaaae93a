"""Operators over tile tables: hierarchy, quadtree, dedup, meshes and documents."""

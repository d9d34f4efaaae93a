"""Spatial tile analytics on Spark: level-of-detail trees, quadtree pyramids, geodesy and tile index documents."""

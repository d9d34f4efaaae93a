"""Geometries of scene nodes: which are collected, which a tile is made of, and nodes that hold both kinds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import GROUP, LOD, OTHER


def collect_geometries(geometries: DataFrame) -> DataFrame:
    """Adds kind: LOD below a level-of-detail node, else OTHER. Geometries without vertices or primitives are left out (columns below_lod, n_vertices, n_primitives)."""
    usable = geometries.filter((F.coalesce("n_vertices", F.lit(0)) > 0) & (F.coalesce("n_primitives", F.lit(0)) > 0))
    return usable.withColumn("kind", F.when(F.col("below_lod"), LOD).otherwise(OTHER))


def select_geometries(collected: DataFrame, tiles: DataFrame, key: str) -> DataFrame:
    """The geometries that a tile (key, type) is made of: the other ones if the tile asks for them or has no level-of-detail ones. A tile without any gives no rows."""
    lods = collected.groupBy(key).agg(F.max(F.col("kind") == LOD).alias("has_lod"))
    wanted = tiles.select(key, "type").join(lods, key).select(key, F.when((F.col("type") == OTHER) | ~F.col("has_lod"), OTHER).otherwise(LOD).alias("kind"))
    return collected.join(wanted, [key, "kind"])


def split_mixed(tiles: DataFrame) -> DataFrame:
    """tile_id, parent_id, type: a node with both kinds (columns has_lod, has_other) becomes a group of two tiles, of which the
    level-of-detail one keeps the node's name and children and the other one has the suffix o."""
    group = F.concat("tile_id", F.lit("#"))
    row = lambda name, up, kind: F.struct(name.alias("tile_id"), up.alias("parent_id"), F.lit(kind).alias("type"))
    name, up, other = F.col("tile_id"), F.col("parent_id"), F.concat("tile_id", F.lit("o"))
    both = F.array(row(group, up, GROUP), row(name, group, LOD), row(other, group, OTHER))
    single = F.array(F.struct(name.alias("tile_id"), up.alias("parent_id"), F.when(F.col("has_lod"), LOD).when(F.col("has_other"), OTHER).otherwise(GROUP).alias("type")))
    return tiles.select(F.inline(F.when(F.col("has_lod") & F.col("has_other"), both).otherwise(single)))


def uv_bbox(vertices: DataFrame, key: str) -> DataFrame:
    """key, min_u, min_v, max_u, max_v of texture coordinates."""
    return vertices.groupBy(key).agg(F.min("u").alias("min_u"), F.min("v").alias("min_v"), F.max("u").alias("max_u"), F.max("v").alias("max_v"))


def coarsest(index: DataFrame) -> DataFrame:
    """tree_id, tile_id, ge of each tree's coarsest node, its root."""
    return index.filter(F.col("depth") == 0).select("tree_id", "tile_id", "ge")

"""Level-of-detail trees as adjacency tables with a path from the root.

Roll-ups explode a node to its ancestors and aggregate with map-side sums, so each is one shuffle of (nodes x depth)
narrow rows, whatever the shape of the tree. A root or a hub with many descendants receives partial aggregates only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import boxes
from ..functions import text as names
from ..model import BOX

GE_FACTOR, GE_FACTOR_OLD, SEED = 1.55, 2.0, 0.1


def closure(links: DataFrame, roots: DataFrame, max_depth: int = 1000) -> DataFrame:
    """Rows of roots and everything reachable from them: id, depth, path, ordinal.

    links: parent, child, ordinal; roots: id. A child that isn't a file of its own is not followed further by the
    caller's links. Each round joins the frontier alone; a child on its own path ends a cycle.
    """
    from ..sources.checkpoint import cut

    level = roots.select(F.col("id"), F.lit(0).alias("depth"), F.array("id").alias("path"), F.lit(0).cast("long").alias("ordinal"))
    found = level
    for _ in range(max_depth):
        step = level.join(links.select(F.col("parent").alias("id"), "child", F.col("ordinal").alias("o")), "id").filter(~F.array_contains("path", F.col("child")))
        level = cut(step.select(F.col("child").alias("id"), (F.col("depth") + 1).alias("depth"), F.concat("path", F.array("child")).alias("path"), F.col("o").cast("long").alias("ordinal")))
        if not level.limit(1).count():
            break
        found = found.unionByName(level)
    return found


def lod_children(files: DataFrame) -> DataFrame:
    """parent, child, ordinal of files(file, child_files): entry 0 is the file itself, names are relative to its folder."""
    each = files.select("file", F.posexplode("child_files").alias("pos", "name")).filter((F.col("pos") >= 1) & (F.length("name") > 0))
    folder = names.parent_path(F.col("file"))
    child = F.when(folder == "", F.col("name")).otherwise(F.concat_ws("/", folder, F.col("name")))
    return each.select(F.col("file").alias("parent"), child.alias("child"), (F.col("pos") - 1).cast("long").alias("ordinal"))


def splice_groups(tiles: DataFrame) -> DataFrame:
    """Children of a group node (type 0) below the root move up to its parent; the group goes. One level, as trees nest groups once."""
    group = tiles.filter((F.col("type") == 0) & F.col("parent_id").isNotNull()).select(F.col("tile_id").alias("gid"), F.col("parent_id").alias("up"))
    joined = tiles.join(group, F.col("parent_id") == F.col("gid"), "left").withColumn("parent_id", F.coalesce("up", "parent_id")).drop("gid", "up")
    return joined.filter((F.col("type") != 0) | F.col("parent_id").isNull())


def flatten(tiles: DataFrame) -> DataFrame:
    """Tiles with content; path order is pre-order."""
    return tiles.filter(F.col("type") > 0)


def roll_up_boxes(tiles: DataFrame) -> DataFrame:
    """tile_id, box: a node's own box united with all below it; nodes without any are absent (null joins back to empty)."""
    own = tiles.filter(~boxes.is_empty()).select(F.explode("path").alias("tile_id"), *BOX)
    return own.groupBy("tile_id").agg(*boxes.aggregates())


def geometric_errors(tiles: DataFrame, rolled: DataFrame, factor: float = GE_FACTOR) -> DataFrame:
    """tile_id, ge of inner nodes (leaves have 0).

    A node whose children are all leaves starts with a tenth of its children's largest box error; others take their
    children's largest error times factor. Scaling by a positive number commutes with max, so the recursion is the
    maximum of seed * factor ** distance over such nodes below.
    """
    inner = tiles.filter(F.col("parent_id").isNotNull()).select(F.col("parent_id").alias("tile_id")).distinct()
    children = tiles.filter(F.col("parent_id").isNotNull()).select("tile_id", "parent_id")
    errors = rolled.select("tile_id", boxes.error_of_box().alias("e"))
    known = children.join(errors, "tile_id", "left").join(inner.withColumn("inner", F.lit(1)), "tile_id", "left")
    seeds = known.groupBy(F.col("parent_id").alias("tile_id")).agg(F.coalesce(F.max("e"), F.lit(0.0)).alias("e"), F.max("inner").alias("inner")).filter("inner is null").select("tile_id", (F.col("e") * SEED).alias("seed"))
    spread = seeds.join(tiles.select("tile_id", "depth", "path"), "tile_id").select(F.posexplode("path").alias("d", "tile"), "depth", "seed")
    return spread.groupBy(F.col("tile").alias("tile_id")).agg(F.max(F.col("seed") * F.pow(F.lit(float(factor)), F.col("depth") - F.col("d"))).alias("ge"))


def tree_index(tiles: DataFrame, factor: float = GE_FACTOR) -> DataFrame:
    """The tiles with rolled-up boxes and errors; nodes without a box are pruned."""
    rolled = roll_up_boxes(tiles)
    errors = geometric_errors(tiles, rolled, factor)
    return tiles.drop(*BOX).join(rolled, "tile_id").join(errors, "tile_id", "left").withColumn("ge", F.coalesce("ge", F.lit(0.0)))


def prune_levels(tiles: DataFrame, levels: str, limit: Column) -> DataFrame:
    """Drops what lies at or below a path element over the limit (levels: array column of the path's levels)."""
    return tiles.filter(F.forall(levels, lambda x: x <= limit))


def depth_histogram(tiles: DataFrame) -> DataFrame:
    return tiles.groupBy("depth").agg(F.count("*").alias("n"))


def auto_depth(counts: DataFrame, low: int = 100, high: int = 2000) -> DataFrame:
    """One row, depth: the shallowest with a count in [low, high], else the deepest of at most high, else the shallowest; 1 without any. The root is skipped."""
    usable = counts.filter(F.col("depth") > 0)
    return usable.agg(
        F.coalesce(F.min(F.when(F.col("n").between(low, high), F.col("depth"))), F.max(F.when(F.col("n") <= high, F.col("depth"))), F.min("depth"), F.lit(1)).cast("int").alias("depth")
    )

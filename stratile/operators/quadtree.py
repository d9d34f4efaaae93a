"""Quadtree pyramid over a sparse grid, by bucketing instead of recursion.

A cell belongs at level k to the node at floor(offset / 2^(k+1)) of its offsets from the smallest coordinates. Level k
is aggregated from level k - 1, which has at most as many rows, so the cells are read once and no level gathers raw
leaves again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import boxes
from ..model import BOX

FACTOR = 1.55


def build_grid(cells: DataFrame) -> DataFrame:
    """One row per (grid_x, grid_y): of several the one with the largest ordinal. Cells without coordinates are dropped."""
    known = cells.filter(F.col("grid_x").isNotNull() & F.col("grid_y").isNotNull())
    last = F.row_number().over(Window.partitionBy("grid_x", "grid_y").orderBy(F.desc("ordinal")))
    return known.withColumn("rank", last).filter("rank = 1").drop("rank")


def extent(grid: DataFrame) -> DataFrame:
    """One row: smallest coordinates, cell count, padded size (a power of two) and the highest level."""
    e = grid.agg(F.min("grid_x").alias("x0"), F.min("grid_y").alias("y0"), F.max("grid_x").alias("x1"), F.max("grid_y").alias("y1"), F.count("*").alias("n"))
    side = F.greatest(F.col("x1") - F.col("x0") + 1, F.col("y1") - F.col("y0") + 1)
    # Powers of two by counting bits: no rounding of logarithms.
    bits = F.when(side <= 1, 0).otherwise(F.length(F.bin((side - 1).cast("long"))))
    return e.withColumn("padded", F.when(F.col("n") > 0, F.pow(F.lit(2), bits).cast("long"))).withColumn("max_level", F.when(F.col("n") > 0, bits - 1).cast("int"))


def pyramid(grid: DataFrame, factor: float = FACTOR) -> DataFrame:
    """level, grid_x, grid_y, grid_size, cells, box, ge of every node with a cell below.

    A level-0 node of one cell keeps its error, others take the largest times factor; each further level multiplies
    by factor. The number of levels is a logarithm, known from one small aggregate.
    """
    e = extent(grid).first()
    if e is None or not e.n or e.max_level < 0:
        return _level(grid.withColumn("cx", F.col("grid_x").cast("long")).withColumn("cy", F.col("grid_y").cast("long")), 0, 0, 0, factor, first=True).filter(F.lit(False))
    level = _level(grid.withColumn("cx", F.floor((F.col("grid_x") - e.x0) / 2)).withColumn("cy", F.floor((F.col("grid_y") - e.y0) / 2)), 0, e.x0, e.y0, factor, first=True)
    found = level
    for k in range(1, e.max_level + 1):
        up = level.withColumn("cx", F.floor((F.col("grid_x") - e.x0) / (2 << k))).withColumn("cy", F.floor((F.col("grid_y") - e.y0) / (2 << k)))
        level = _level(up, k, e.x0, e.y0, factor, first=False)
        found = found.unionByName(level)
    return found


def _level(rows: DataFrame, k: int, x0: int, y0: int, factor: float, first: bool) -> DataFrame:
    cells = F.count("*") if first else F.sum("cells")
    ge = F.max("ge") * (F.when(F.count("*") == 1, 1.0).otherwise(factor) if first else F.lit(factor))
    merged = rows.groupBy("cx", "cy").agg(cells.alias("cells"), *boxes.aggregates(), ge.alias("ge"))
    size = 2 << k
    return merged.select(F.lit(k).alias("level"), (F.col("cx") * size + x0).cast("int").alias("grid_x"), (F.col("cy") * size + y0).cast("int").alias("grid_y"), F.lit(size).alias("grid_size"), "cells", *BOX, "ge")


def leaf_paths(grid: DataFrame, level: int, x0: int, y0: int) -> DataFrame:
    """grid_x, grid_y, stems (sorted) of the nodes of one level."""
    size = 2 << level
    node = lambda c, o: (F.floor((F.col(c) - o) / size) * size + o).cast("int")
    return grid.groupBy(node("grid_x", x0).alias("grid_x"), node("grid_y", y0).alias("grid_y")).agg(F.array_sort(F.collect_list("stem")).alias("stems"))

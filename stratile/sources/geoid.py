"""Geoid grids: default folders and names, a reader of grid files, interpolated undulations."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Grid files of the models (fixed values).
FILES = {"EGM84": "egm84-15", "EGM96": "egm96-5", "EGM2008": "egm2008-5"}


def geoid_folder(environment: Mapping[str, str] = os.environ) -> str:
    """Where grids are kept unless an option says otherwise."""
    if environment.get("GEOGRAPHICLIB_GEOID_PATH"):
        return environment["GEOGRAPHICLIB_GEOID_PATH"]
    if environment.get("GEOGRAPHICLIB_DATA"):
        return environment["GEOGRAPHICLIB_DATA"] + "/geoids"
    return "/usr/local/share/GeographicLib/geoids"


def load_geoid(spark: SparkSession, model: str, folder: str = "") -> DataFrame | None:
    """The model's grid; None for NONE, an error for an unknown model."""
    if model == "NONE":
        return None
    if model not in FILES:
        raise ValueError(f"unknown geoid model {model}")
    return read_geoid(spark, f"{folder or geoid_folder()}/{FILES[model]}.pgm")


def read_geoid(spark: SparkSession, path: str) -> DataFrame:
    """gx, gy, nx, n of a binary grey map: columns from longitude 0 eastwards (nx of them round the globe), rows from latitude 90 southwards, n in metres by the offset and scale in its comments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content").to_pylist():
                head = re.match(rb"P5\s+((?:#[^\n]*\n)*)\s*(\d+)\s+(\d+)\s+(\d+)\s", raw)
                if head is None:
                    raise ValueError("not a binary grey map")
                width, height, top = (int(head[i]) for i in (2, 3, 4))
                note = {k.lower(): float(v) for k, v in re.findall(rb"#\s*(\w+)\s+([-+0-9.eE]+)\s*\n", head[1])}
                values = np.frombuffer(raw, ">u2" if top > 255 else "u1", width * height, head.end()).reshape(height, width)
                for gy in range(height):
                    n = values[gy] * note.get(b"scale", 1.0) + note.get(b"offset", 0.0)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int64)), pa.array(np.full(width, gy, np.int64)), pa.array(np.full(width, width, np.int64)), pa.array(n)], names=["gx", "gy", "nx", "n"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "gx long, gy long, nx long, n double")


def _weights(t: Column, cubic: bool) -> list[tuple[int, Column]]:
    """Offsets and weights of neighbours at a fraction t between two grid lines: linear, or cubic convolution."""
    if not cubic:
        return [(0, 1 - t), (1, t)]
    near = lambda d: (1.5 * d - 2.5) * d * d + 1
    far = lambda d: ((-0.5 * d + 2.5) * d - 4) * d + 2
    return [(-1, far(1 + t)), (0, near(t)), (1, near(1 - t)), (2, far(2 - t))]


def undulations(points: DataFrame, grid: DataFrame, columns: int, cubic: bool = True, id_col: str = "id") -> DataFrame:
    """id, n of points (id, lon, lat in degrees) on a grid (gx, gy, n) of so many columns round the globe; null where a neighbour is missing.

    A point meets its neighbours (4 or 16) by an equi-join on grid coordinates, which a small grid is broadcast for and a hot cell
    is split in, and a map-side sum. Columns wrap round; rows beyond a pole are the pole's.
    """
    step = 360.0 / columns
    at_x, at_y = F.pmod(F.col("lon"), F.lit(360.0)) / step, (90.0 - F.col("lat")) / step
    placed = points.select(F.col(id_col).alias("id"), F.floor(at_x).alias("x"), F.floor(at_y).alias("y"), (at_x - F.floor(at_x)).alias("tx"), (at_y - F.floor(at_y)).alias("ty"))
    last = columns // 2
    cells = [
        F.struct(F.pmod(F.col("x") + i, F.lit(columns)).alias("gx"), F.least(F.greatest(F.col("y") + j, F.lit(0)), F.lit(last)).alias("gy"), (u * v).alias("w"))
        for i, u in _weights(F.col("tx"), cubic)
        for j, v in _weights(F.col("ty"), cubic)
    ]
    around = placed.select("id", F.inline(F.array(*cells)))
    met = around.join(grid.select("gx", "gy", "n"), ["gx", "gy"], "left")
    total = met.groupBy("id").agg(F.sum(F.col("w") * F.col("n")).alias("n"), F.count("n").alias("known"))
    return total.select("id", F.when(F.col("known") == len(cells), F.col("n")).alias("n"))

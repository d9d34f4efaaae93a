"""Incremental roll-ups: tiles arrive as a stream, boxes of their ancestors are kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import boxes
from ..model import BOX


def streaming_boxes(tiles: DataFrame) -> DataFrame:
    """tile_id, box, tiles of every ancestor seen so far (a streaming frame with path and box columns); state is one row per node.

    Unions only grow, so late tiles need no watermark: write in update mode.
    """
    own = tiles.filter(~boxes.is_empty()).select(F.explode("path").alias("tile_id"), *BOX)
    return own.groupBy("tile_id").agg(*boxes.aggregates(), F.count("*").alias("tiles"))

"""Reader of tile index documents: nested JSON to rows, level by level."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .checkpoint import cut


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a tile index document (see index_rows)."""
    raw = spark.read.option("wholetext", True).text(path)
    return index_rows(raw.select(F.input_file_name().alias("tree_id"), F.expr("try_variant_get(try_parse_json(value), '$.root', 'variant')").alias("tile")))


def index_rows(roots: DataFrame, max_depth: int = 1000, levels: int | None = None) -> DataFrame:
    """tree_id, depth, place (child numbers from the root), uri, ge, box of every tile of the variant column tile.

    A column depth is the depth at which a document's root stands. levels: the number of levels where it is known; then no level is written and counted before the next.
    """
    spark = roots.sparkSession
    keep = cut if levels is None else lambda df: df
    top = F.col("depth") if "depth" in roots.columns else F.lit(0)
    level = keep(roots.filter("tile is not null").select("tree_id", top.alias("depth"), F.expr("cast(array() as array<int>)").alias("place"), "tile"))
    found = None
    for k in range(max_depth if levels is None else levels):
        rows = level.select(
            "tree_id",
            "depth",
            "place",
            F.expr("try_variant_get(tile, '$.content.uri', 'string')").alias("uri"),
            F.expr("try_variant_get(tile, '$.geometricError', 'double')").alias("ge"),
            F.expr("try_variant_get(tile, '$.boundingVolume.box', 'array<double>')").alias("box"),
        )
        found = rows if found is None else found.unionByName(rows)
        if k + 1 == levels:
            break
        level = keep(spark.sql("select tree_id, depth + 1 as depth, concat(place, array(c.pos)) as place, c.value as tile from {level}, lateral variant_explode_outer(try_variant_get(tile, '$.children', 'variant')) as c where c.value is not null", level=level))
        if levels is None and not level.limit(1).count():
            break
    return found

"""Schemas and option records of the tile model.

A tree is an adjacency table: Spark has no recursive type, so nesting exists only in encoded documents. Boxes are six
nullable double columns; all null means that the box is unknown (an empty box).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

BOX = ("min_x", "min_y", "min_z", "max_x", "max_y", "max_z")

_BOX_FIELDS = [T.StructField(c, T.DoubleType()) for c in BOX]

TILE = T.StructType(
    [
        T.StructField("tree_id", T.StringType()),
        T.StructField("tile_id", T.StringType()),
        T.StructField("parent_id", T.StringType()),
        T.StructField("ordinal", T.LongType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("path", T.ArrayType(T.StringType())),
        T.StructField("type", T.IntegerType()),
        T.StructField("file_name", T.StringType()),
        *_BOX_FIELDS,
    ]
)

VERTEX = T.StructType(
    [T.StructField("geom_id", T.LongType()), T.StructField("vertex_id", T.IntegerType())] + [T.StructField(c, T.FloatType()) for c in ("x", "y", "z", "nx", "ny", "nz", "u", "v")]
)

PRIMITIVE = T.StructType([T.StructField("geom_id", T.LongType()), T.StructField("prim_no", T.IntegerType()), T.StructField("mode", T.StringType()), T.StructField("indices", T.ArrayType(T.LongType()))])

TEXTURE = T.StructType(
    [
        T.StructField("tex_id", T.LongType()),
        T.StructField("w", T.IntegerType()),
        T.StructField("h", T.IntegerType()),
        T.StructField("fmt", T.StringType()),
        T.StructField("row_step", T.IntegerType()),
        T.StructField("row_size", T.IntegerType()),
        T.StructField("data", T.BinaryType()),
    ]
)

GRID_CELL = T.StructType([T.StructField("stem", T.StringType()), T.StructField("grid_x", T.IntegerType()), T.StructField("grid_y", T.IntegerType()), T.StructField("coarsest_path", T.StringType()), *_BOX_FIELDS, T.StructField("ge", T.DoubleType()), T.StructField("glb_uri", T.StringType())])

#: Tile kinds: a group without content, level-of-detail nodes, other geometry.
GROUP, LOD, OTHER = 0, 1, 2


@dataclass(frozen=True)
class Simplification:
    error: float = 0.01
    ratio: float = 0.5


@dataclass(frozen=True)
class Quantization:
    """Bits per attribute (positions, normals, texture coordinates, generic)."""

    position: int = 11
    normal: int = 10
    uv: int = 12
    generic: int = 8


@dataclass(frozen=True)
class GeoidConfig:
    enabled: bool = False
    model: str = "NONE"
    data_path: str = ""


@dataclass(frozen=True)
class Options:
    """One conversion's options; names follow the command line with underscores."""

    input: str = ""
    output: str = ""
    config: str = ""
    split_json: bool = False
    split_depth: int = 1
    top_reconstruct: bool = False
    top_texture_max_size: int = 512
    max_level: int | None = None
    unlit: bool = True
    lon: float = 0.0
    lat: float = 0.0
    alt: float = 0.0
    simplify_meshes: bool = False
    simplify: Simplification = field(default_factory=Simplification)
    quantize: Quantization = field(default_factory=Quantization)
    geoid: GeoidConfig = field(default_factory=GeoidConfig)

    def __post_init__(self) -> None:
        if self.split_depth < 0:
            raise ValueError("split_depth must not be negative")
        if not 0 < self.simplify.ratio <= 1:
            raise ValueError("the simplification ratio must be in (0, 1]")

"""Readers of a tile folder: scene files, metadata, configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

CONFIG = "x double, y double, offset double, max_lvl int"


def scan_tiles(spark: SparkSession, folder: str, suffix: str = "osgb") -> DataFrame:
    """stem, path, grid_x, grid_y of every folder of Data/ with a scene file of its own name; listing reads no content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{suffix}").load(f"{folder}/Data").select("path", "length")
    own = F.regexp_extract("path", rf"/Data/([^/]+)/([^/]+)\.{suffix}$", 1)
    file = F.regexp_extract("path", rf"/Data/([^/]+)/([^/]+)\.{suffix}$", 2)
    found = files.select(own.alias("stem"), file.alias("file"), "path", "length").filter("stem = file and stem <> ''").drop("file")
    return found.withColumns({"grid_x": text.grid_x(F.col("stem")), "grid_y": text.grid_y(F.col("stem"))})


def read_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """version, srs, srs_origin of metadata.xml; malformed markup is no error, an empty srs gives no row."""
    raw = spark.read.option("wholetext", True).text(f"{folder}/metadata.xml").select("value")
    return metadata_columns(raw).filter("srs <> ''")


def metadata_columns(raw: DataFrame) -> DataFrame:
    s = F.col("value")
    field = lambda tag: F.trim(text.decode_entities(text.tag_or_attribute(s, tag, "ModelMetadata")))
    return raw.select(text.tag_attribute(s, "ModelMetadata", "version").alias("version"), field("SRS").alias("srs"), field("SRSOrigin").alias("srs_origin"))


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """x, y, offset, max_lvl; every key is optional and an unreadable document gives nulls."""
    raw = spark.read.option("wholetext", True).text(path)
    return raw.select(F.from_json("value", CONFIG).alias("c")).select("c.*")


def crs_columns(srs: str) -> dict:
    """kind, code, first, second of a reference system text: ENU:lat,lon or EPSG:code; text without a colon is WKT; others are UNSUPPORTED."""
    s = F.col(srs)
    head, rest = F.substring_index(s, ":", 1), F.when(F.instr(s, ":") > 0, F.expr(f"substring({srs}, instr({srs}, ':') + 1)"))
    kind = F.when(F.instr(s, ":") == 0, "WKT").when(head == "ENU", "ENU").when(head == "EPSG", "EPSG").otherwise("UNSUPPORTED")
    number = lambda i: F.when(head == "ENU", F.get(F.split(rest, ","), F.lit(i)).try_cast("double"))
    return {"crs_kind": kind, "crs_code": F.when(head == "EPSG", rest.try_cast("int")), "crs_lat": number(0), "crs_lon": number(1)}

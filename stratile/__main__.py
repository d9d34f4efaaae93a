"""Command line: convert a tile folder, split a tile index."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .convert import convert, split
from .model import Options, Simplification
from .sources import files


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="stratile", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    c = commands.add_parser("convert", help="models and tileset.json of a folder with metadata.xml and Data/")
    c.add_argument("-i", "--input", required=True)
    c.add_argument("-o", "--output", required=True)
    c.add_argument("-c", "--config", default="", help="JSON with x, y and max_lvl, all optional")
    c.add_argument("--enable-simplify", action="store_true", help="thin meshes to the ratio")
    c.add_argument("--simplify-ratio", type=float, default=Simplification.ratio)
    c.add_argument("--enable-unlit", action="store_true")
    c.add_argument("--split-json", action="store_true", help="an index file for each tree")
    c.add_argument("--enable-top-reconstruct", action="store_true", help="merged levels above the trees")
    c.add_argument("--lon", type=float, default=0.0)
    c.add_argument("--lat", type=float, default=0.0)
    c.add_argument("--alt", type=float, default=0.0)
    s = commands.add_parser("split", help="cut an index document into files")
    s.add_argument("-i", "--input", required=True)
    s.add_argument("-o", "--output", required=True)
    s.add_argument("-d", "--depth", type=int, help="default: the shallowest depth with a number of tiles in range")
    s.add_argument("--min-tiles", type=int, default=100)
    s.add_argument("--max-tiles", type=int, default=2000)
    return top


def options_of(spark: SparkSession, given: argparse.Namespace) -> Options:
    """Options of the command line; a configuration's centre counts where none is given."""
    lon, lat, level = given.lon, given.lat, None
    if given.config:
        c = files.read_config(spark, given.config).first()
        lon, lat, level = lon or (c.x if c else None) or 0.0, lat or (c.y if c else None) or 0.0, c.max_lvl if c else None
    return Options(given.input, given.output, given.config, split_json=given.split_json, top_reconstruct=given.enable_top_reconstruct, max_level=level, unlit=given.enable_unlit, lon=lon, lat=lat, alt=given.alt, simplify_meshes=given.enable_simplify, simplify=Simplification(ratio=given.simplify_ratio))


def main(argv: list[str] | None = None) -> int:
    given = parser().parse_args(argv)
    spark = SparkSession.builder.appName("stratile").getOrCreate()
    try:
        if given.command == "convert":
            convert(spark, options_of(spark, given))
        else:
            print(f"split at depth {split(spark, given.input, given.output, given.depth, given.min_tiles, given.max_tiles)}")
    except ValueError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())

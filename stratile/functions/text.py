"""Text and path columns: tags, entities, file names, tile names and URIs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def tag_text(s: Column, tag: str) -> Column:
    """Text between the first <tag> and the next </tag>; "" without both."""
    t = re.escape(tag)
    return F.coalesce(F.regexp_extract(s, rf"<{t}>([\s\S]*?)</{t}>", 1), F.lit(""))


def tag_attribute(s: Column, tag: str, attribute: str) -> Column:
    """Value of a quoted attribute in the first opening tag; "" if absent."""
    return F.coalesce(F.regexp_extract(s, rf'<{re.escape(tag)}(?=[\s>])[^>]*?\s{re.escape(attribute)}="([^"]*)"', 1), F.lit(""))


def tag_or_attribute(s: Column, tag: str, parent: str) -> Column:
    """The element form of a value, or its attribute form on the parent where the element is empty."""
    return F.coalesce(F.nullif(tag_text(s, tag), F.lit("")), tag_attribute(s, parent, tag))


def decode_entities(s: Column) -> Column:
    """Quote, ampersand, less, greater, decoded in this order, each until none is left (so a doubly escaped sign is decoded)."""
    s = F.replace(s, F.lit("&quot;"), F.lit('"'))
    s = F.regexp_replace(s, "&(?:amp;)+", "&")
    s = F.replace(s, F.lit("&lt;"), F.lit("<"))
    return F.replace(s, F.lit("&gt;"), F.lit(">"))


def split_parts(s: Column, delimiter: str) -> Column:
    """Parts between delimiters: empty ones in the middle stay, an empty last one goes."""
    parts = F.split(s, re.escape(delimiter), -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def parent_path(path: Column) -> Column:
    """Before the last separator; "" without one."""
    return F.regexp_extract(path, r"^([\s\S]*)[/\\][^/\\]*$", 1)


def stem(path: Column) -> Column:
    """Base name without its last extension."""
    return F.regexp_replace(base_name(path), r"\.[^.]*$", "")


def replace_first(s: Column, old: Column, new: Column) -> Column:
    """The first occurrence only; an absent or empty one changes nothing."""
    at = F.instr(s, old)
    return F.when((at > 0) & (F.length(old) > 0), F.concat(F.substr(s, F.lit(1), at - 1), new, F.substr(s, at + F.length(old)))).otherwise(s)


def lod_level(file: Column) -> Column:
    """Digits after the first _L up to the next _, else the digits the stem ends in, else -1."""
    name = stem(file)
    marked = F.regexp_extract(name, r"^(?:(?!_L)[\s\S])*_L([0-9]+)(?:_|$)", 1)
    trailing = F.regexp_extract(name, r"([0-9]+)$", 1)
    digits = F.coalesce(F.nullif(marked, F.lit("")), F.nullif(trailing, F.lit("")))
    return F.coalesce(digits.try_cast("int"), F.lit(-1))


_GRID = r"^Tile_\s*([+-]?[0-9]+)[^_]*_\s*([+-]?[0-9]+)"


def grid_x(name: Column) -> Column:
    """First coordinate of a Tile_<x>_<y> name; null if the name has another form."""
    return F.nullif(F.regexp_extract(name, _GRID, 1), F.lit("")).try_cast("int")


def grid_y(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, _GRID, 2), F.lit("")).try_cast("int")


def output_name(file: Column, kind: Column) -> Column:
    """Scene file -> mesh file; other geometry gets the letter o."""
    return F.regexp_replace(file, r"\.osgb$", F.when(kind == 2, "o.glb").otherwise(".glb"))


def mesh_name(level: Column, x: Column, y: Column, root_level: Column) -> Column:
    """Name of a merged mesh: levels count from the top, the root one's children are L0."""
    return F.when(level == root_level, F.lit("root.glb")).otherwise(F.format_string("L%d_X%+04d_Y%+04d.glb", root_level - 1 - level, x, y))


def index_name(level: Column, x: Column, y: Column, root_level: Column) -> Column:
    """Name of a split-off index: the root has display level 0."""
    return F.format_string("HLOD_L%d_X%+04d_Y%+04d.json", root_level - level, x, y)


def tile_uri(uri: Column, name: Column) -> Column:
    """./x of tree name -> ./Data/name/x."""
    return F.when(uri.startswith("./"), F.concat(F.lit("./Data/"), name, F.substr(uri, F.lit(2)))).otherwise(uri)


def sub_index_uri(uri: Column) -> Column:
    """./x seen from one folder below."""
    return F.regexp_replace(uri, r"^\./", "../")


def geoid_model(name: Column) -> Column:
    """Model name, all lower or all upper case; anything else is NONE."""
    known = ("egm84", "egm96", "egm2008")
    out = F.lit("NONE")
    for k in known:
        out = F.when(name.isin(k, k.upper()), k.upper()).otherwise(out)
    return F.coalesce(out, F.lit("NONE"))


def crs_text(kind: Column, *values: Column) -> Column:
    return F.concat(kind, F.lit("("), F.concat_ws(", ", *values), F.lit(")"))

"""Queries over the synthetic grid: one cell per customer, 39 cells a row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import boxes, geo, text
from ..model import BOX
from ..operators import documents, quadtree
from .trees import table


def cells(spark, sf_dir) -> DataFrame:
    """stem, grid_x, grid_y, box, ge and ordinal; the box is the customer's cell with its balance as height."""
    k = F.col("c_custkey")
    x, y = (k % 39 - 20).cast("int"), (F.floor(k / 39) - 20).cast("int")
    lo = [x.cast("double"), y.cast("double"), F.lit(0.0)]
    hi = [x + 1.0, y + 1.0, F.abs("c_acctbal")]
    named = dict(zip(BOX, [*lo, *hi], strict=True))
    return table(spark, sf_dir, "customer").select(F.format_string("Tile_%+04d_%+04d", x, y).alias("stem"), x.alias("grid_x"), y.alias("grid_y"), *(c.alias(n) for n, c in named.items()), (F.abs("c_acctbal") / 100).alias("ge"), k.alias("ordinal"))


def tile_scan_parse(spark, sf_dir):
    """Names of tile files, parsed back to coordinates and level."""
    k = F.col("c_custkey")
    x, y = (k % 39 - 20).cast("int"), (F.floor(k / 39) - 20).cast("int")
    name = F.when(k % 7 == 0, F.concat(F.lit("Foo_"), k.cast("string"))).otherwise(F.format_string("Tile_%+04d_%+04d_L%d_0.osgb", x, y, (k % 23).cast("int")))
    named = table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"))
    parsed = named.select("c_custkey", text.grid_x(F.col("name")).alias("grid_x"), text.grid_y(F.col("name")).alias("grid_y"), text.lod_level(F.col("name")).alias("level"))
    return parsed.filter("grid_x is not null")


def grid_build(spark, sf_dir):
    """Cells on a coarser grid, where later cells overwrite earlier ones."""
    coarse = cells(spark, sf_dir).withColumns({"grid_x": F.floor(F.col("grid_x") / 3).cast("int"), "grid_y": F.floor(F.col("grid_y") / 3).cast("int")})
    return quadtree.build_grid(coarse).select("grid_x", "grid_y", "stem", "ge", "ordinal")


def grid_extent(spark, sf_dir):
    return quadtree.extent(cells(spark, sf_dir)).select(F.col("x0"), F.col("y0"), F.col("n"), F.col("padded"), F.col("max_level"))


def quadtree_pyramid(spark, sf_dir):
    return quadtree.pyramid(cells(spark, sf_dir)).withColumn("ge", F.round("ge", 4))


def quadtree_leaves(spark, sf_dir):
    """Stems below each node of level 2 (coordinates start at -20)."""
    return quadtree.leaf_paths(cells(spark, sf_dir), 2, -20, -20).select("grid_x", "grid_y", F.concat_ws(",", "stems").alias("stems"))


def grid_probe(spark, sf_dir):
    """Cells that have a neighbour to the right: an equi-join on coordinates, misses are skipped."""
    a = cells(spark, sf_dir).select("stem", "grid_x", "grid_y")
    b = a.select(F.col("stem").alias("right_stem"), (F.col("grid_x") - 1).alias("grid_x"), "grid_y")
    return a.join(b, ["grid_x", "grid_y"])


def level_ratio(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", geo.level_ratio(F.col("p_size") % 6, 0.5).alias("ratio"))


def hlod_names(spark, sf_dir):
    """Names of merged meshes and split-off indexes of all pyramid nodes."""
    nodes = quadtree.pyramid(cells(spark, sf_dir))
    top = F.lit(quadtree.extent(cells(spark, sf_dir)).first().max_level)
    return nodes.select("level", "grid_x", "grid_y", text.mesh_name(F.col("level"), F.col("grid_x"), F.col("grid_y"), top).alias("mesh"), text.index_name(F.col("level"), F.col("grid_x"), F.col("grid_y"), top).alias("sub_index"))


def split_selection(spark, sf_dir):
    """Nodes that are cut off into files of their own: display level equal to the split depth (1)."""
    nodes = quadtree.pyramid(cells(spark, sf_dir))
    top = quadtree.extent(cells(spark, sf_dir)).first().max_level
    return nodes.filter(F.lit(top) - F.col("level") == 1).select("level", "grid_x", "grid_y", "cells")


def quadtree_json(spark, sf_dir):
    """The whole pyramid as one nested document."""
    nodes = quadtree.pyramid(cells(spark, sf_dir))
    return documents.quadtree_documents(nodes, quadtree.extent(cells(spark, sf_dir)).first().max_level)


def quadtree_index(spark, sf_dir):
    """The pyramid with content at every node and the cells' documents at its leaves."""
    found = cells(spark, sf_dir)
    nodes = quadtree.pyramid(found)
    top = quadtree.extent(found).first().max_level
    named = nodes.withColumn("uri", F.when(F.col("level") % 2 == 0, F.concat(F.lit("./top/"), text.mesh_name(F.col("level"), F.col("grid_x"), F.col("grid_y"), F.lit(top)))))
    trees = found.filter("ordinal % 7 <> 3").select("stem", F.concat(documents.tile_head(), F.lit(',"children":[]}')).alias("json"))
    return documents.quadtree_index(named, top, found, trees)


def grid_padding(spark, sf_dir):
    """Content boxes of cells: the tile's box padded once more."""
    return cells(spark, sf_dir).select("stem", *(c.alias(n) for n, c in boxes.padded(0.2).items()))


CELLS = """
with cells as (
  select printf('Tile_%+04d_%+04d', x, y) stem, x grid_x, y grid_y, x::double min_x, y::double min_y, 0::double min_z, x + 1.0::double max_x, y + 1.0::double max_y, abs(c_acctbal) max_z, abs(c_acctbal) / 100 ge, c_custkey ordinal
  from (select *, (c_custkey % 39 - 20)::int x, (c_custkey // 39 - 20)::int y from customer)),
ext as (select min(grid_x) x0, min(grid_y) y0, count(*) n, greatest(max(grid_x) - min(grid_x), max(grid_y) - min(grid_y)) + 1 side from cells),
lv as (select *, case when side <= 1 then 0 else length(bin(side::bigint - 1)) end bits from ext)
"""
_PYRAMID = f"""{CELLS}, l0 as (
  select ((grid_x - x0) // 2) cx, ((grid_y - y0) // 2) cy, count(*) n, max(ge) * case when count(*) = 1 then 1.0::double else 1.55::double end ge, min(min_x) min_x, min(min_y) min_y, min(min_z) min_z, max(max_x) max_x, max(max_y) max_y, max(max_z) max_z from cells, ext group by 1, 2),
levels as (select unnest(range((select bits from lv))) level),
nodes as (
  select level::int level, (cx // (1::bigint << level) * (2::bigint << level) + x0)::int grid_x, (cy // (1::bigint << level) * (2::bigint << level) + y0)::int grid_y, (2::bigint << level)::int grid_size, sum(l0.n)::bigint cells,
    min(min_x) min_x, min(min_y) min_y, min(min_z) min_z, max(max_x) max_x, max(max_y) max_y, max(max_z) max_z, round(max(l0.ge * power(1.55::double, level)), 4) ge
  from l0, levels, ext group by 1, 2, 3, 4)"""

_N12 = "printf('[%.6f,%.6f,%.6f,%.6f,0.000000,0.000000,0.000000,%.6f,0.000000,0.000000,0.000000,%.6f]', (max_x + min_x) / 2, (max_y + min_y) / 2, (max_z + min_z) / 2, greatest(max_x - min_x, 0.01::double) / 2, greatest(max_y - min_y, 0.01::double) / 2, greatest(max_z - min_z, 0.01::double) / 2)"
_NODE = f"""'{{"geometricError":' || printf('%.2f', ge) || ',"refine":"REPLACE","boundingVolume":{{"box":' || {_N12} || '}}'"""
LEVELS = 12


def _nested_sql(content: str, leaves: str) -> str:
    """Documents level by level, up to LEVELS of them."""
    exact = _PYRAMID.replace("round(max(l0.ge * power(1.55::double, level)), 4) ge", "max(l0.ge * power(1.55::double, level)) ge")
    levels = [f"d0 as (select grid_x, grid_y, {_NODE} || {content} || ',\"children\":[' || coalesce(c, '') || ']}}' json from pn left join ({leaves}) lf on lf.x = grid_x and lf.y = grid_y where level = 0)"]
    for k in range(1, LEVELS):
        levels.append(f"""k{k} as (select ((grid_x - x0) // {2 << k} * {2 << k} + x0)::int x, ((grid_y - y0) // {2 << k} * {2 << k} + y0)::int y, string_agg(json, ',' order by grid_y, grid_x) c from d{k - 1}, ext group by 1, 2),
      d{k} as (select grid_x, grid_y, {_NODE} || {content} || ',"children":[' || coalesce(c, '') || ']}}' json from pn left join k{k} on x = grid_x and y = grid_y where level = {k})""")
    pick = " union all ".join(f"select '{k}_' || grid_x || '_' || grid_y tile_id, json from d{k} where (select bits - 1 from lv) = {k}" for k in range(LEVELS))
    return f"{exact}, pn as (select * from nodes), {', '.join(levels)} {pick}"


_CONTENT = f"""case when level % 2 = 0 then ',"content":{{"uri":"./top/' || case when level = (select bits - 1 from lv) then 'root.glb' else printf('L%d_X%+04d_Y%+04d.glb', (select (bits - 1)::int from lv) - 1 - level, grid_x, grid_y) end || '","extensions":{{"3DTILES_content_gltf":{{}}}},"boundingVolume":{{"box":' || (select {_N12} from (select {', '.join(f'o.min_{a} - (o.max_{a} - o.min_{a}) * (0.2::double / 2) min_{a}, o.max_{a} + (o.max_{a} - o.min_{a}) * (0.2::double / 2) max_{a}' for a in 'xyz')})) || '}}}}' else '' end"""
_CONTENT = _CONTENT.replace("o.m", "pn.m")
_LEAVES = f"""select ((grid_x - x0) // 2 * 2 + x0)::int x, ((grid_y - y0) // 2 * 2 + y0)::int y, string_agg({_NODE} || ',"children":[]}}', ',' order by stem) c from cells, ext where ordinal % 7 <> 3 group by 1, 2"""

QUERIES = {f.__name__: f for f in (tile_scan_parse, grid_build, grid_extent, quadtree_pyramid, quadtree_leaves, grid_probe, level_ratio, hlod_names, split_selection, quadtree_json, quadtree_index, grid_padding)}

ORACLE_SQL = {
    "tile_scan_parse": "select c_custkey, (c_custkey % 39 - 20)::int grid_x, (c_custkey // 39 - 20)::int grid_y, (c_custkey % 23)::int \"level\" from customer where c_custkey % 7 <> 0",
    "grid_build": f"{CELLS} select floor(grid_x / 3)::int grid_x, floor(grid_y / 3)::int grid_y, arg_max(stem, ordinal) stem, arg_max(ge, ordinal) ge, max(ordinal) ordinal from cells group by 1, 2",
    "grid_extent": f"{CELLS} select x0, y0, n, (1::bigint << bits) padded, (bits - 1)::int max_level from lv",
    "quadtree_pyramid": f"{_PYRAMID} select * from nodes",
    "quadtree_leaves": f"{CELLS} select ((grid_x + 20) // 8 * 8 - 20)::int grid_x, ((grid_y + 20) // 8 * 8 - 20)::int grid_y, string_agg(stem, ',' order by stem) stems from cells group by 1, 2",
    "grid_probe": f"{CELLS} select a.grid_x, a.grid_y, a.stem, b.stem right_stem from cells a join cells b on b.grid_x = a.grid_x + 1 and b.grid_y = a.grid_y",
    "level_ratio": "select p_partkey, greatest(0.01::double, 0.5::double * power(0.25::double, p_size % 6 + 1)) ratio from part",
    "hlod_names": f"{_PYRAMID} select level, grid_x, grid_y, case when level = m then 'root.glb' else printf('L%d_X%+04d_Y%+04d.glb', m - 1 - level, grid_x, grid_y) end mesh, printf('HLOD_L%d_X%+04d_Y%+04d.json', m - level, grid_x, grid_y) sub_index from nodes, (select (bits - 1)::int m from lv)",
    "split_selection": f"{_PYRAMID} select level, grid_x, grid_y, cells from nodes where (select bits - 1 from lv) - level = 1",
    "quadtree_json": _nested_sql("''", "select null::int x, null::int y, null::varchar c"),
    "quadtree_index": _nested_sql(_CONTENT, _LEAVES),
    "grid_padding": f"{CELLS} select stem, {', '.join(f'min_{a} - (max_{a} - min_{a}) * (0.2::double / 2) min_{a}, max_{a} + (max_{a} - min_{a}) * (0.2::double / 2) max_{a}' for a in 'xyz')} from cells",
}

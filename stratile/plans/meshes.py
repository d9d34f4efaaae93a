"""Queries of the mesh and dedup operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, geometry, mesh
from .trees import table


def normal_fix(spark, sf_dir):
    k = F.col("l_partkey")
    scale = F.when(k % 5 == 0, 0.0).when(k % 5 == 1, 1.0).otherwise(2.0)
    x, y, z = F.col("l_discount") * scale, F.col("l_tax") * scale, F.when(k % 5 == 0, 0.0).otherwise(0.5)
    n = mesh.fixed_normal(x, y, z)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *(F.round(c, 6).alias(f"n{a}") for c, a in zip(n, "xyz", strict=True)))


def _indices(spark, sf_dir):
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select("p_partkey", F.transform(F.sequence(F.lit(0), (k % 11 + 3).cast("int")), lambda i: (i * 7 + k % 100).cast("long")).alias("indices"))


def triangulate_quads(spark, sf_dir):
    return _indices(spark, sf_dir).select("p_partkey", F.array_join(mesh.triangulate_quads("indices").cast("array<string>"), ",").alias("triangles"))


def quad_strip(spark, sf_dir):
    return _indices(spark, sf_dir).select("p_partkey", F.array_join(mesh.triangulate_strip("indices").cast("array<string>"), ",").alias("triangles"))


def index_range(spark, sf_dir):
    """Smallest and largest index and the width that holds them."""
    top = F.array_max("indices") * (F.col("p_partkey") % 4) * 100
    return _indices(spark, sf_dir).select("p_partkey", F.array_min("indices").alias("low"), top.alias("high"), mesh.index_width(top).alias("bytes"))


def index_width(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_partkey").alias("high")).select("l_orderkey", mesh.index_width(F.col("high") * 37).alias("bytes"))


def texture_size(spark, sf_dir):
    w, h = (F.col("p_size") * 37).cast("int"), (F.col("p_partkey") % 900 + 1).cast("int")
    a, b = mesh.texture_size(w, h, 512)
    return table(spark, sf_dir, "part").select("p_partkey", a.alias("w"), b.alias("h"))


def texture_dedup(spark, sf_dir):
    """The first document of each content."""
    docs = table(spark, sf_dir, "documents").select("doc_id", dedup.content_key(F.col("text")).alias("key"))
    return dedup.first_wins(docs, "key", "doc_id").select("doc_id", "canonical")


def vertex_dedup(spark, sf_dir):
    """Equal line items of an order (quantity and discount rounded to coarse steps) share an index."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("ordinal"), F.floor(F.col("l_quantity") / 25).alias("x"), F.floor(F.col("l_discount") * 20).alias("y"))
    return dedup.dedup_vertices(items.distinct(), "l_orderkey", "ordinal", ["x", "y"])


def material_index(spark, sf_dir):
    """Ship flags as textures of an order: numbered per order, 0 for items without one."""
    flag = F.when(F.col("l_returnflag") != "N", F.concat("l_returnflag", "l_linestatus"))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", flag.alias("tex"))
    return dedup.material_index(items, "l_orderkey", "tex").select("l_orderkey", "l_linenumber", "l_partkey", F.col("index").cast("int").alias("material"))


def missing_material(spark, sf_dir):
    """Material numbers of primitives: unknown ones are 0."""
    return table(spark, sf_dir, "part").select("p_partkey", F.greatest(F.col("p_size") - 25, F.lit(0)).alias("material"))


def quantized_positions(spark, sf_dir):
    box = table(spark, sf_dir, "lineitem").agg(F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))
    return table(spark, sf_dir, "lineitem").join(F.broadcast(box)).select("l_orderkey", "l_linenumber", "l_partkey", mesh.quantized(F.col("l_quantity"), F.col("lo"), F.col("hi"), 11).alias("q"))  # one row


def vertex_clustering(spark, sf_dir):
    points = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_discount") * 100).alias("z"))
    return mesh.cluster_vertices(points, "l_suppkey", 10.0).select("l_suppkey", "cluster_x", "cluster_y", "cluster_z", *(F.round(a, 9).alias(a) for a in "xyz"), "n")


def smooth_normals(spark, sf_dir):
    """Triangles from an order's vertex, quantity and price."""
    k = F.col("l_linenumber").cast("double")
    corner = lambda i: [(F.col("l_quantity") + i * k).alias(f"{'abc'[i]}x"), (F.col("l_discount") * 100 + (i == 1) * 3.0).alias(f"{'abc'[i]}y"), (F.col("l_tax") * 100 + (i == 2) * 2.0).alias(f"{'abc'[i]}z")]
    tris = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("geom"), (F.col("l_linenumber") % 2).alias("a"), (F.col("l_linenumber") % 2 + 1).alias("b"), F.lit(3).alias("c"), *corner(0), *corner(1), *corner(2))
    return mesh.smooth_normals(tris).select("geom", "vertex", *(F.round(f"n{a}", 5).alias(f"n{a}") for a in "xyz"))


def _points(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("ordinal"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"), F.col("l_discount").alias("z"))


def glb_container(spark, sf_dir):
    made = mesh.tile_models(_points(spark, sf_dir), "l_orderkey")
    return made.select("l_orderkey", F.length("content").alias("bytes"), F.expr("substring(content, 1, 4)").cast("string").alias("magic"), F.sha2("content", 256).alias("sha"))


def b3dm_container(spark, sf_dir):
    made = mesh.tile_models(_points(spark, sf_dir), "l_orderkey", wrap=True)
    return made.select("l_orderkey", F.length("content").alias("bytes"), F.expr("substring(content, 1, 4)").cast("string").alias("magic"), F.sha2("content", 256).alias("sha"))


def glb_layout(spark, sf_dir):
    """What the containers of all orders say of themselves."""
    made = mesh.tile_models(_points(spark, sf_dir), "l_orderkey")
    return made.select("l_orderkey", *(c.alias(n) for n, c in mesh.container_layout(F.col("content")).items()))


def b3dm_layout(spark, sf_dir):
    """The same of the models inside batched containers, which start behind 28 bytes and two documents."""
    made = mesh.tile_models(_points(spark, sf_dir), "l_orderkey", wrap=True)
    head = F.lit(28 + 20 + 40)
    inner = F.expr("substring(content, 89)")
    return made.select("l_orderkey", F.substring("content", 1, 4).cast("string").alias("outer"), (F.length("content") % 8).alias("rest"), head.alias("head"), *(c.alias(n) for n, c in mesh.container_layout(inner).items() if n != "whole"))


def geometry_collection(spark, sf_dir):
    """Line items as geometries: those with vertices and primitives, by kind."""
    return geometry.collect_geometries(_geometries(spark, sf_dir)).select("l_orderkey", "geom", "kind")


def _geometries(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("geom"), (F.col("l_returnflag") == "R").alias("below_lod"), (F.col("l_partkey") % 5).alias("n_vertices"), (F.col("l_suppkey") % 4).alias("n_primitives"))


def geometry_selection(spark, sf_dir):
    """The geometries that each order's tile is made of."""
    kinds = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderkey") % 3).alias("type"))
    return geometry.select_geometries(geometry.collect_geometries(_geometries(spark, sf_dir)), kinds, "l_orderkey").select("l_orderkey", "geom", "kind")


def mixed_nodes(spark, sf_dir):
    """Orders with returned and other items become groups of two tiles."""
    sides = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max(F.col("l_returnflag") == "R").alias("has_lod"), F.max(F.col("l_returnflag") == "N").alias("has_other"))
    return geometry.split_mixed(sides.select(F.col("l_orderkey").cast("string").alias("tile_id"), (F.col("l_orderkey") % 10).cast("string").alias("parent_id"), "has_lod", "has_other"))


def uv_bbox(spark, sf_dir):
    return geometry.uv_bbox(table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_discount").alias("u"), F.col("l_tax").alias("v")), "l_orderkey")


_N = "with n as (select l_orderkey, count(*) n, 3 * greatest(count(*) - 2, 0) k from lineitem group by 1)"
_GEO = "with g as (select l_orderkey, l_linenumber * 1000000 + l_partkey geom, case when l_returnflag = 'R' then 1 else 2 end kind from lineitem where l_partkey % 5 > 0 and l_suppkey % 4 > 0)"
_I = "with i as (select p_partkey, list_transform(range(p_partkey % 11 + 4), lambda i: i * 7 + p_partkey % 100) v from part)"

QUERIES = {f.__name__: f for f in (normal_fix, triangulate_quads, quad_strip, index_range, index_width, texture_size, texture_dedup, vertex_dedup, material_index, missing_material, quantized_positions, vertex_clustering, smooth_normals, glb_container, b3dm_container, glb_layout, b3dm_layout, geometry_collection, geometry_selection, mixed_nodes, uv_bbox)}

ORACLE_SQL = {
    "smooth_normals": """with q as (select l_orderkey geom, l_linenumber n, l_linenumber::double k, l_quantity ax, l_discount * 100 ay, l_tax * 100 az from lineitem),
      d as (select geom, n, ax + k - ax ux, ay + 3.0::double - ay uy, az - az uz, ax + 2 * k - ax vx, ay - ay vy, az + 2.0::double - az vz from q),
      f as (select geom, unnest([n % 2, n % 2 + 1, 3]) vertex, uy * vz - uz * vy x, uz * vx - ux * vz y, ux * vy - uy * vx z from d),
      s as (select geom, vertex, sum(x) x, sum(y) y, sum(z) z from f group by 1, 2), l as (select *, sqrt(x * x + y * y + z * z) l from s)
      select geom, vertex, round(case when l < 1e-4 then 0 when abs(l - 1) <= 1e-4 then x else x / l end, 5) nx, round(case when l < 1e-4 then 0 when abs(l - 1) <= 1e-4 then y else y / l end, 5) ny, round(case when l < 1e-4 then 1 when abs(l - 1) <= 1e-4 then z else z / l end, 5) nz from l""",
    "glb_layout": f"{_N} select l_orderkey, 'glTF' magic, 2::bigint \"version\", true whole, k::bigint indices, n::bigint positions, 5121::bigint component, (k + (4 - k % 4) % 4 + 12 * n)::bigint \"data\" from n",
    "b3dm_layout": f"{_N} select l_orderkey, 'b3dm' \"outer\", 0 rest, 88 head, 'glTF' magic, 2::bigint \"version\", k::bigint indices, n::bigint positions, 5121::bigint component, (k + (4 - k % 4) % 4 + 12 * n)::bigint \"data\" from n",
    "geometry_collection": f"{_GEO} select * from g",
    "geometry_selection": f"{_GEO}, w as (select l_orderkey, case when l_orderkey % 3 = 2 or min(kind) = 2 then 2 else 1 end kind from g group by 1) select * from g join w using (l_orderkey, kind)",
    "mixed_nodes": """with s as (select l_orderkey::varchar t, (l_orderkey % 10)::varchar p, bool_or(l_returnflag = 'R') a, bool_or(l_returnflag = 'N') b from lineitem group by l_orderkey)
      select t tile_id, p parent_id, case when a then 1 when b then 2 else 0 end "type" from s where not (a and b)
      union all select t || '#', p, 0 from s where a and b union all select t, t || '#', 1 from s where a and b union all select t || 'o', t || '#', 2 from s where a and b""",
    "uv_bbox": "select l_orderkey, min(l_discount) min_u, min(l_tax) min_v, max(l_discount) max_u, max(l_tax) max_v from lineitem group by 1",
    "normal_fix": """with v as (select l_orderkey, l_linenumber, l_partkey, l_discount * case l_partkey % 5 when 0 then 0::double when 1 then 1::double else 2::double end x, l_tax * case l_partkey % 5 when 0 then 0::double when 1 then 1::double else 2::double end y, case when l_partkey % 5 = 0 then 0::double else 0.5::double end z from lineitem),
      n as (select *, sqrt(x * x + y * y + z * z) n from v)
      select l_orderkey, l_linenumber, l_partkey, round(case when n < 1e-4 then 0 when abs(n - 1) <= 1e-4 then x else x / n end, 6) nx, round(case when n < 1e-4 then 0 when abs(n - 1) <= 1e-4 then y else y / n end, 6) ny, round(case when n < 1e-4 then 1 when abs(n - 1) <= 1e-4 then z else z / n end, 6) nz from n""",
    "triangulate_quads": f"{_I} select p_partkey, case when len(v) % 4 = 0 then array_to_string(flatten(list_transform(range(len(v) // 4), lambda q: [v[q * 4 + 1], v[q * 4 + 2], v[q * 4 + 3], v[q * 4 + 1], v[q * 4 + 3], v[q * 4 + 4]])), ',') end triangles from i",
    "quad_strip": f"{_I} select p_partkey, case when len(v) % 2 = 0 and len(v) >= 4 then array_to_string(flatten(list_transform(range(len(v) // 2 - 1), lambda q: [v[q * 2 + 1], v[q * 2 + 2], v[q * 2 + 3], v[q * 2 + 2], v[q * 2 + 4], v[q * 2 + 3]])), ',') end triangles from i",
    "index_range": f"{_I}, t as (select p_partkey, list_min(v) low, list_max(v) * (p_partkey % 4) * 100 high from i) select *, case when high <= 255 then 1 when high <= 65535 then 2 else 4 end::int bytes from t",
    "index_width": "select l_orderkey, case when max(l_partkey) * 37 <= 255 then 1 when max(l_partkey) * 37 <= 65535 then 2 else 4 end::int bytes from lineitem group by 1",
    "texture_size": "with t as (select p_partkey, (p_size * 37)::int w, (p_partkey % 900 + 1)::int h from part) select p_partkey, case when greatest(w, h) > 512 then greatest(1, floor(w * (512.0::double / greatest(w, h))))::int else w end w, case when greatest(w, h) > 512 then greatest(1, floor(h * (512.0::double / greatest(w, h))))::int else h end h from t",
    "texture_dedup": "select doc_id, min(doc_id) over (partition by text) canonical from documents",
    "vertex_dedup": """with v as (select distinct l_orderkey, l_linenumber * 1000000 + l_partkey ordinal, floor(l_quantity / 25)::bigint x, floor(l_discount * 20)::bigint y from lineitem),
      f as (select *, min(ordinal) over (partition by l_orderkey, x, y) first from v) select l_orderkey, ordinal, (dense_rank() over (partition by l_orderkey order by first, x, y) - 1)::int new_index from f""",
    "material_index": "with t as (select l_orderkey, l_linenumber, l_partkey, case when l_returnflag <> 'N' then l_returnflag || l_linestatus end tex from lineitem), n as (select l_orderkey, tex, row_number() over (partition by l_orderkey order by tex) - 1 i from (select distinct l_orderkey, tex from t where tex is not null)) select t.l_orderkey, l_linenumber, l_partkey, coalesce(i, 0)::int material from t left join n on n.l_orderkey = t.l_orderkey and n.tex = t.tex",
    "missing_material": "select p_partkey, greatest(p_size - 25, 0) material from part",
    "quantized_positions": "with b as (select min(l_quantity) lo, max(l_quantity) hi from lineitem) select l_orderkey, l_linenumber, l_partkey, floor((l_quantity - lo) / (hi - lo) * 2047.0::double + 0.5::double)::bigint q from lineitem, b",
    "vertex_clustering": "with p as (select l_suppkey, l_quantity x, l_extendedprice / 1000 y, l_discount * 100 z from lineitem) select l_suppkey, floor(x / 10)::bigint cluster_x, floor(y / 10)::bigint cluster_y, floor(z / 10)::bigint cluster_z, round(avg(x), 9) x, round(avg(y), 9) y, round(avg(z), 9) z, count(*) n from p group by 1, 2, 3, 4",
}

"""Queries over the synthetic tile tree: region > nation > customer > order, orders are leaf tiles, line items their vertices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boxes, text
from ..model import BOX
from ..operators import documents, hierarchy

MAX_DEPTH = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def leaf_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """l_orderkey, box: the vertices are reduced before anything else is joined."""
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*boxes.point_aggregates("l_quantity", "l_extendedprice", "l_discount"))


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree with own boxes. Orders without line items are tiles with an empty box."""
    name = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    above = customer.join(F.broadcast(nation.select("n_nationkey", "n_regionkey")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows at every scale
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(leaf_boxes(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    none = [F.lit(None).cast("double").alias(c) for c in BOX]
    r, n, c, o = name("r", "n_regionkey"), name("n", "n_nationkey"), name("c", "c_custkey"), name("o", "o_orderkey")
    row = lambda key, up, depth, kind, path, box, number: [F.lit("t").alias("tree_id"), key.alias("tile_id"), up.alias("parent_id"), F.lit(depth).alias("depth"), F.lit(kind).alias("type"), F.array(*path).alias("path"), F.col(number).cast("long").alias("ordinal"), *box]
    top = F.lit(None).cast("string")
    regions = region.select(F.col("r_regionkey").alias("n_regionkey")).select(*row(r, top, 0, 0, [r], none, "n_regionkey"))
    nations = nation.select(*row(n, r, 1, 0, [r, n], none, "n_nationkey"))
    customers = above.select(*row(c, n, 2, 0, [r, n, c], none, "c_custkey"))
    leaves = orders.join(above, F.col("o_custkey") == F.col("c_custkey")).select(*row(o, c, 3, 1, [r, n, c, o], BOX, "o_orderkey"))
    return regions.unionByName(nations).unionByName(customers).unionByName(leaves)


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def vertex_bbox(spark, sf_dir):
    return leaf_boxes(spark, sf_dir)


def box_union(spark, sf_dir):
    """Each customer's box: union of its orders' boxes."""
    joined = table(spark, sf_dir, "orders").join(leaf_boxes(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.groupBy("o_custkey").agg(*boxes.aggregates())


def box_rollup(spark, sf_dir):
    return hierarchy.roll_up_boxes(tiles(spark, sf_dir))


def tile_tree_index(spark, sf_dir):
    index = hierarchy.tree_index(tiles(spark, sf_dir))
    return _rounded(index.select("tile_id", "parent_id", "depth", *BOX, "ge"), 6, "ge")


def _errors(spark, sf_dir, factor):
    t = tiles(spark, sf_dir)
    return _rounded(hierarchy.geometric_errors(t, hierarchy.roll_up_boxes(t), factor), 6, "ge")


def geometric_error(spark, sf_dir):
    return _errors(spark, sf_dir, hierarchy.GE_FACTOR)


def ge_1_0(spark, sf_dir):
    return _errors(spark, sf_dir, hierarchy.GE_FACTOR_OLD)


def empty_prune(spark, sf_dir):
    """Tiles that stay in the index: those with a box after the roll-up."""
    t = tiles(spark, sf_dir)
    return t.select("tile_id", "depth").join(hierarchy.roll_up_boxes(t).select("tile_id"), "tile_id")


def max_level_prune(spark, sf_dir):
    """Tiles none of whose path elements has a level over 17 (level: digits of the name, as file names have them)."""
    t = tiles(spark, sf_dir)
    levels = F.transform("path", lambda p: text.lod_level(F.concat(F.lit("Tile_L"), (F.substring(p, 2, 18).cast("long") % 23).cast("string"), F.lit("_0.osgb"))))
    return hierarchy.prune_levels(t.withColumn("levels", levels), "levels", F.lit(17)).select("tile_id", "depth")


def box_pad(spark, sf_dir):
    df = leaf_boxes(spark, sf_dir)
    return df.select("l_orderkey", *(c.alias(n) for n, c in boxes.padded(0.2).items()))


def _numbers(spark, sf_dir, floor):
    numbers = boxes.center_axes(floor)
    return leaf_boxes(spark, sf_dir).select("l_orderkey", *(numbers[i].alias(f"b{i}") for i in (0, 1, 2, 3, 7, 11)))


def box12_floor(spark, sf_dir):
    return _numbers(spark, sf_dir, 0.01)


def box12(spark, sf_dir):
    return _numbers(spark, sf_dir, 0.0)


def root_box(spark, sf_dir):
    """Box and error of a root over the region trees: padded boxes, the largest two-decimal error, capped."""
    index = hierarchy.tree_index(tiles(spark, sf_dir)).filter("depth = 0")
    padded = index.select(*(c.alias(n) for n, c in boxes.padded(0.2).items()), documents.printf_fixed(F.col("ge"), 2).cast("double").alias("ge"))
    return padded.agg(*boxes.aggregates(), F.max("ge").alias("e")).select(*BOX, F.least("e", F.lit(documents.GE_CAP)).alias("ge"), F.col("e").alias("ge_uncapped"))


def flatten(spark, sf_dir):
    return hierarchy.flatten(tiles(spark, sf_dir)).select("tile_id", "parent_id", F.concat_ws("/", "path").alias("path"))


def closure(spark, sf_dir):
    """All tiles below each region, found by following child links."""
    t = tiles(spark, sf_dir)
    links = t.filter("parent_id is not null").select(F.col("parent_id").alias("parent"), F.col("tile_id").alias("child"), "ordinal")
    found = hierarchy.closure(links, t.filter("depth = 0").select(F.col("tile_id").alias("id")))
    return found.select("id", "depth", F.concat_ws("/", "path").alias("path"))


def splice_groups(spark, sf_dir):
    """Nations as groups without content: their customers move up to the regions."""
    t = tiles(spark, sf_dir).withColumn("type", F.when(F.col("depth") == 1, 0).otherwise(1))
    return hierarchy.splice_groups(t).select("tile_id", "parent_id")


def depth_histogram(spark, sf_dir):
    return hierarchy.depth_histogram(tiles(spark, sf_dir))


def auto_depth(spark, sf_dir):
    return hierarchy.auto_depth(hierarchy.depth_histogram(tiles(spark, sf_dir)))


def lod_children(spark, sf_dir):
    """Child files of each order's file: entries 1 and on of a list made of its line numbers."""
    files = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_linenumber")).alias("n"))
    named = files.select(F.concat(F.lit("Data/T"), F.col("l_orderkey").cast("string"), F.lit("/T.osgb")).alias("file"), F.concat(F.array(F.lit("T.osgb")), F.transform("n", lambda i: F.concat(F.lit("T_L"), i.cast("string"), F.lit(".osgb")))).alias("child_files"))
    return hierarchy.lod_children(named)


def lod_siblings(spark, sf_dir):
    """Geometry choice per order: level-of-detail rows (R) unless there are none, else the others; fallback as the tile asks for."""
    items = table(spark, sf_dir, "lineitem")
    sides = items.groupBy("l_orderkey").agg(F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("lod"), F.count(F.when(F.col("l_returnflag") != "R", 1)).alias("other"))
    kind = F.col("l_orderkey") % 3
    return sides.select("l_orderkey", F.when((kind == 2) | (F.col("lod") == 0), F.col("other")).otherwise(F.col("lod")).alias("chosen"))


TREE = """
with leafbox as (select l_orderkey, min(l_quantity) min_x, min(l_extendedprice) min_y, min(l_discount) min_z, max(l_quantity) max_x, max(l_extendedprice) max_y, max(l_discount) max_z from lineitem group by 1),
above as (select c_custkey, n_nationkey, n_regionkey from customer join nation on c_nationkey = n_nationkey),
tiles as (
  select 'r' || r_regionkey tile_id, null::varchar parent_id, 0 depth, ['r' || r_regionkey] path, r_regionkey::bigint ordinal, 0 "type", null::double min_x, null::double min_y, null::double min_z, null::double max_x, null::double max_y, null::double max_z from region
  union all select 'n' || n_nationkey, 'r' || n_regionkey, 1, ['r' || n_regionkey, 'n' || n_nationkey], n_nationkey, 0, null, null, null, null, null, null from nation
  union all select 'c' || c_custkey, 'n' || n_nationkey, 2, ['r' || n_regionkey, 'n' || n_nationkey, 'c' || c_custkey], c_custkey, 0, null, null, null, null, null, null from above
  union all select 'o' || o_orderkey, 'c' || c_custkey, 3, ['r' || n_regionkey, 'n' || n_nationkey, 'c' || c_custkey, 'o' || o_orderkey], o_orderkey, 1, b.min_x, b.min_y, b.min_z, b.max_x, b.max_y, b.max_z
    from orders join above on o_custkey = c_custkey left join leafbox b on l_orderkey = o_orderkey),
rolled as (
  select tile_id, min(min_x) min_x, min(min_y) min_y, min(min_z) min_z, max(max_x) max_x, max(max_y) max_y, max(max_z) max_z
  from (select unnest(path) tile_id, min_x, min_y, min_z, max_x, max_y, max_z from tiles where min_x is not null) group by 1),
inn as (select distinct parent_id tile_id from tiles where parent_id is not null),
seeds as (
  select t.parent_id tile_id, coalesce(max(greatest(max_x - min_x, max_y - min_y, max_z - min_z) / 2), 0) * 0.1::double seed
  from tiles t left join (select * from rolled) using (tile_id) left join inn i on i.tile_id = t.tile_id
  where t.parent_id is not null group by 1 having count(i.tile_id) = 0),
spread as (select seed, depth, unnest(path) tile, unnest(range(len(path))) d from seeds join tiles using (tile_id))
"""
# The rolled box is joined by name, so the tiles' own box columns must not be in the way.
TREE = TREE.replace("from tiles t left join (select * from rolled) using (tile_id)", "from (select tile_id, parent_id from tiles) t left join rolled using (tile_id)")

_GE = "select tile tile_id, max(seed * power({f}::double, depth - d)) ge from spread group by 1"
_BOX = ", ".join(BOX)
_INDEX = f"select t.tile_id, t.parent_id, t.depth, t.\"type\", t.ordinal, t.path, {', '.join('r.' + c for c in BOX)}, coalesce(g.ge, 0) ge from tiles t join rolled r on r.tile_id = t.tile_id left join ({_GE.format(f=1.55)}) g on g.tile_id = t.tile_id"
_LEAF = "with b as (select l_orderkey, min(l_quantity) min_x, min(l_extendedprice) min_y, min(l_discount) min_z, max(l_quantity) max_x, max(l_extendedprice) max_y, max(l_discount) max_z from lineitem group by 1)"
_PAD = ", ".join(f"min_{a} - (max_{a} - min_{a}) * (0.2::double / 2) min_{a}, max_{a} + (max_{a} - min_{a}) * (0.2::double / 2) max_{a}" for a in "xyz")

QUERIES = {f.__name__: f for f in (tile_tree_index, vertex_bbox, box_union, box_rollup, geometric_error, ge_1_0, empty_prune, max_level_prune, box_pad, box12_floor, box12, root_box, flatten, closure, splice_groups, depth_histogram, auto_depth, lod_children, lod_siblings)}

ORACLE_SQL = {
    "tile_tree_index": f"{TREE} select tile_id, parent_id, depth, {_BOX}, round(ge, 6) ge from ({_INDEX})",
    "vertex_bbox": f"{_LEAF} select * from b",
    "box_union": f"{_LEAF} select o_custkey, min(min_x) min_x, min(min_y) min_y, min(min_z) min_z, max(max_x) max_x, max(max_y) max_y, max(max_z) max_z from orders left join b on l_orderkey = o_orderkey group by 1",
    "box_rollup": f"{TREE} select * from rolled",
    "geometric_error": f"{TREE} select tile_id, round(ge, 6) ge from ({_GE.format(f=1.55)})",
    "ge_1_0": f"{TREE} select tile_id, round(ge, 6) ge from ({_GE.format(f=2.0)})",
    "empty_prune": f"{TREE} select t.tile_id, t.depth from tiles t join rolled using (tile_id)",
    "max_level_prune": f"{TREE} select tile_id, depth from tiles where len(list_filter(path, lambda p: substr(p, 2)::bigint % 23 > 17)) = 0",
    "box_pad": f"{_LEAF} select l_orderkey, {_PAD} from b",
    "box12_floor": f"{_LEAF} select l_orderkey, (max_x + min_x) / 2 b0, (max_y + min_y) / 2 b1, (max_z + min_z) / 2 b2, greatest(max_x - min_x, 0.01::double) / 2 b3, greatest(max_y - min_y, 0.01::double) / 2 b7, greatest(max_z - min_z, 0.01::double) / 2 b11 from b",
    "box12": f"{_LEAF} select l_orderkey, (max_x + min_x) / 2 b0, (max_y + min_y) / 2 b1, (max_z + min_z) / 2 b2, abs(max_x - min_x) / 2 b3, abs(max_y - min_y) / 2 b7, abs(max_z - min_z) / 2 b11 from b",
    "root_box": f"{TREE}, p as (select {_PAD}, printf('%.2f', ge)::double ge from ({_INDEX}) where depth = 0) select min(min_x) min_x, min(min_y) min_y, min(min_z) min_z, max(max_x) max_x, max(max_y) max_y, max(max_z) max_z, least(max(ge), 2000.0::double) ge, max(ge) ge_uncapped from p",
    "flatten": f"{TREE} select tile_id, parent_id, array_to_string(path, '/') path from tiles where \"type\" > 0",
    "closure": f"{TREE} select tile_id id, depth, array_to_string(path, '/') path from tiles",
    "splice_groups": f"{TREE} select t.tile_id, coalesce(g.parent_id, t.parent_id) parent_id from tiles t left join tiles g on g.tile_id = t.parent_id and g.depth = 1 where t.depth <> 1",
    "depth_histogram": f"{TREE} select depth, count(*) n from tiles group by 1",
    "auto_depth": f"{TREE}, h as (select depth, count(*) n from tiles where depth > 0 group by 1) select coalesce(min(depth) filter (n between 100 and 2000), max(depth) filter (n <= 2000), min(depth), 1)::int depth from h",
    "lod_children": "select distinct 'Data/T' || l_orderkey || '/T.osgb' parent, 'Data/T' || l_orderkey || '/T_L' || l_linenumber || '.osgb' child, dense_rank() over (partition by l_orderkey order by l_linenumber) - 1 ordinal from lineitem",
    "lod_siblings": "select l_orderkey, case when l_orderkey % 3 = 2 or count(*) filter (l_returnflag = 'R') = 0 then count(*) filter (l_returnflag <> 'R') else count(*) filter (l_returnflag = 'R') end chosen from lineitem group by 1",
}

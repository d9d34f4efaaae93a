"""Hand-computed fixtures: trees, boxes, grids, names, text, geodesy, meshes, documents."""

from __future__ import annotations

import hashlib
import json
import struct

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from stratile import sinks
from stratile.functions import boxes, geo, text
from stratile.model import BOX, Options
from stratile.operators import dedup, documents, hierarchy, mesh, quadtree
from stratile.plans import indexes as plans_indexes
from stratile.plans import meshes
from stratile.sources import files, indexes
from stratile.streaming import streaming_boxes

TILE = "tile_id string, parent_id string, depth int, path array<string>, ordinal long, type int, " + ", ".join(f"{c} double" for c in BOX)


@pytest.fixture(scope="module")
def tree(spark):
    none = (None,) * 6
    rows = [
        ("R", None, 0, ["R"], 0, 0, *none),
        ("A", "R", 1, ["R", "A"], 0, 0, *none),
        ("B", "R", 1, ["R", "B"], 1, 1, 20.0, 0.0, 0.0, 21.0, 1.0, 1.0),
        ("A1", "A", 2, ["R", "A", "A1"], 0, 1, 0.0, 0.0, 0.0, 10.0, 4.0, 2.0),
        ("A2", "A", 2, ["R", "A", "A2"], 1, 2, 2.0, 2.0, 0.0, 8.0, 8.0, 6.0),
        ("E", "R", 1, ["R", "E"], 2, 1, *none),
    ]
    return spark.createDataFrame(rows, TILE)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(("factor", "root"), [(1.55, 0.775), (2.0, 1.0)])
def test_tree(tree, factor, root):
    index = {r.tile_id: r for r in hierarchy.tree_index(tree, factor).collect()}
    assert set(index) == {"R", "A", "B", "A1", "A2"}  # the empty leaf is pruned
    assert [index["R"][c] for c in BOX] == [0, 0, 0, 21, 8, 6]
    assert [index["A"][c] for c in BOX] == [0, 0, 0, 10, 8, 6]
    assert index["A"].ge == pytest.approx(0.5)
    assert index["R"].ge == pytest.approx(root)
    assert index["A1"].ge == 0


def test_all_empty_tree(spark):
    rows = [("R", None, 0, ["R"], 0, 0, *(None,) * 6), ("A", "R", 1, ["R", "A"], 0, 1, *(None,) * 6)]
    assert hierarchy.tree_index(spark.createDataFrame(rows, TILE)).count() == 0


def test_boxes(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 10.0, 4.0, 0.0)], ", ".join(f"{c} double" for c in BOX))
    padded = df.select(*(c.alias(n) for n, c in boxes.padded(0.2).items())).first()
    assert (padded.min_x, padded.max_x) == (-1, 11)
    assert df.select(boxes.center_axes(0.01).alias("v")).first().v == [5, 2, 0, 5, 0, 0, 0, 2, 0, 0, 0, 0.005]
    assert df.select(boxes.center_axes().alias("v")).first().v[11] == 0
    assert df.select(documents.box_json().alias("v")).first().v.startswith("[5.000000,2.000000,0.000000,5.000000,0.000000")


def test_grid(spark):
    rows = [("a", -1, 50, 2.0), ("b", 0, 50, 4.0), ("c", 2, 53, 1.0)]
    grid = spark.createDataFrame([(s, x, y, *([0.0] * 6), g, i) for i, (s, x, y, g) in enumerate(rows)], "stem string, grid_x int, grid_y int, " + ", ".join(f"{c} double" for c in BOX) + ", ge double, ordinal long")
    e = quadtree.extent(grid).first()
    assert (e.padded, e.max_level) == (4, 1)
    nodes = {(r.level, r.grid_x, r.grid_y): (r.cells, round(r.ge, 6)) for r in quadtree.pyramid(grid).collect()}
    assert nodes == {(0, -1, 50): (2, 6.2), (0, 1, 52): (1, 1.0), (1, -1, 50): (3, 9.61)}
    top = json.loads(documents.quadtree_documents(quadtree.pyramid(grid), 1).first().json)
    assert len(top["children"]) == 2
    assert value(spark, text.mesh_name(F.lit(0), F.lit(-1), F.lit(50), F.lit(1))) == "L0_X-001_Y+050.glb"
    assert value(spark, text.mesh_name(F.lit(1), F.lit(-1), F.lit(50), F.lit(1))) == "root.glb"
    assert value(spark, text.index_name(F.lit(0), F.lit(1), F.lit(52), F.lit(1))) == "HLOD_L1_X+001_Y+052.json"
    assert [value(spark, geo.level_ratio(F.lit(k), 0.5)) for k in (0, 1, 2)] == [0.125, 0.03125, 0.01]


def test_grid_edge_cases(spark):
    schema = "stem string, grid_x int, grid_y int, " + ", ".join(f"{c} double" for c in BOX) + ", ge double, ordinal long"
    assert quadtree.pyramid(spark.createDataFrame([], schema)).count() == 0
    one = spark.createDataFrame([("a", 3, 3, *([0.0] * 6), 1.0, 0)], schema)
    assert quadtree.pyramid(one).count() == 0  # one cell has no level
    twice = spark.createDataFrame([("a", 3, 3, *([0.0] * 6), 1.0, 0), ("b", 3, 3, *([0.0] * 6), 2.0, 1), ("x", None, 3, *([0.0] * 6), 2.0, 2)], schema)
    assert [r.stem for r in quadtree.build_grid(twice).collect()] == ["b"]


@pytest.mark.parametrize(("name", "want"), [("Tile_-001_+050", (-1, 50, 50)), ("Tile_+012_-003_L14_0", (12, -3, 14)), ("Tile_x_1", (None, None, 1)), ("Foo_1_2", (None, None, 2)), ("Tile_+001_+002_y", (1, 2, -1))])
def test_names(spark, name, want):
    n = F.lit(name)
    assert (value(spark, text.grid_x(n)), value(spark, text.grid_y(n)), value(spark, text.lod_level(n))) == want


def test_text(spark):
    assert value(spark, text.decode_entities(F.lit("&amp;lt;a&gt;"))) == "<a>"
    assert value(spark, text.decode_entities(F.lit("A &amp;amp; B"))) == "A & B"
    assert value(spark, text.split_parts(F.lit("1,,2,"), ",")) == ["1", "", "2"]
    assert value(spark, text.tile_uri(F.lit("./x.glb"), F.lit("S"))) == "./Data/S/x.glb"
    assert value(spark, text.sub_index_uri(F.lit("./Data/S/x.glb"))) == "../Data/S/x.glb"
    assert value(spark, text.replace_first(F.lit("aXbXc"), F.lit("X"), F.lit("--"))) == "a--bXc"
    assert value(spark, text.base_name(F.lit("a\\b/c.d"))) == "c.d"
    assert value(spark, text.parent_path(F.lit("c.d"))) == ""
    assert value(spark, text.tag_text(F.lit("<a>1</a><a>2</a>"), "a")) == "1"
    assert value(spark, text.geoid_model(F.lit("Egm96"))) == "NONE"


def test_geodesy(spark):
    x = [value(spark, c) for c in geo.ecef(F.lit(120.0), F.lit(30.0), F.lit(0.0))]
    assert x == pytest.approx([-2764128.319646, 4787610.688268, 3170373.735384], abs=1e-6)
    assert [value(spark, c) for c in geo.ecef(F.lit(0.0), F.lit(90.0), F.lit(0.0))] == pytest.approx([0, 0, 6356752.314245], abs=1e-6)
    m = value(spark, geo.enu_to_ecef(F.lit(120.0), F.lit(30.0), F.lit(0.0)))
    assert m[:3] == pytest.approx([-0.866025, -0.5, 0], abs=1e-6)
    assert m[8:11] == pytest.approx([-0.433013, 0.75, 0.5], abs=1e-6)
    back = geo.ecef_to_enu(geo.ecef(F.lit(120.0), F.lit(30.0), F.lit(0.0)), F.lit(120.0), F.lit(30.0), F.lit(0.0))
    assert [value(spark, c) for c in back] == pytest.approx([0, 0, 0], abs=1e-9)
    lon, lat = geo.utm(F.lit(500000.0), F.lit(0.0), 32650)
    assert (value(spark, lon), value(spark, lat)) == pytest.approx((117.0, 0.0))
    with pytest.raises(ValueError, match="not a WGS84 UTM zone"):
        geo.utm(F.lit(0.0), F.lit(0.0), 4326)


def test_affine_fit_recovers_affine_maps(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 5.0, 7.0, 9.0)], ", ".join(f"{c} double" for c in BOX))
    fit = geo.affine_fit(lambda x, y, z: (x * 2 + y - z + 3, y * -1.5, x + y + z))
    got = [df.select(c.alias("v")).first().v for row in fit for c in row]
    assert got == pytest.approx([2, 1, -1, 3, 0, -1.5, 0, 0, 1, 1, 1, 0])


def test_meshes(spark):
    df = spark.createDataFrame([(list(range(8)),), (list(range(6)),), (list(range(5)),)], "i array<long>")
    quads = [r.v for r in df.select(mesh.triangulate_quads("i").alias("v")).collect()]
    strips = [r.v for r in df.select(mesh.triangulate_strip("i").alias("v")).collect()]
    assert quads == [[0, 1, 2, 0, 2, 3, 4, 5, 6, 4, 6, 7], None, None]
    assert strips[1:] == [[0, 1, 2, 1, 3, 2, 2, 3, 4, 3, 5, 4], None]
    assert [value(spark, mesh.index_width(F.lit(n))) for n in (255, 256, 65535, 65536)] == [1, 2, 2, 4]
    model = mesh.glb(np.array([[0, 0, 0], [1, 0, 0], [0, 1, 0]]), np.array([0, 1, 2]))
    magic, version, size = struct.unpack_from("<4sII", model)
    assert (magic, version, size) == (b"glTF", 2, len(model))
    head = json.loads(model[20 : 20 + struct.unpack_from("<I", model, 12)[0]])
    assert head["accessors"][1]["max"] == [1, 1, 0]
    wrapped = mesh.b3dm(model)
    assert wrapped[:4] == b"b3dm"
    assert struct.unpack_from("<I", wrapped, 8)[0] == len(wrapped)
    feature, batch = (struct.unpack_from("<I", wrapped, k)[0] for k in (12, 20))
    assert (28 + feature) % 8 == 0
    assert batch % 8 == 0
    assert wrapped[28 + feature + batch :].startswith(b"glTF")


@pytest.mark.parametrize(("query", "wrap"), [(meshes.glb_container, lambda m: m), (meshes.b3dm_container, mesh.b3dm)])
def test_containers_hold_every_order(spark, tmp_path, query, wrap):
    items = [(order, line, order * 13 + line, float(order + line), order * 100.5 / line, line / 100) for order in range(1, 33) for line in range(1, order % 7 + 2)]
    spark.createDataFrame(items[::-1], "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, l_discount double").write.parquet(str(tmp_path / "lineitem.parquet"))
    want = {}
    for order in {i[0] for i in items}:
        points = [i[3:] for i in items if i[0] == order]
        fan = [i for k in range(1, len(points) - 1) for i in (0, k, k + 1)]
        model = wrap(mesh.glb(np.array(points, np.float32), np.array(fan, np.int64)))
        want[order] = (len(model), model[:4].decode(), hashlib.sha256(model).hexdigest())
    got = query(spark, str(tmp_path)).collect()
    assert len(got) == len(want)
    assert {r.l_orderkey: (r.bytes, r.magic, r.sha) for r in got} == want


def test_dedup_is_idempotent(spark):
    rows = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (5, None), (4, "b")], "id long, text string")
    once = dedup.first_wins(rows.withColumn("key", dedup.content_key(F.col("text"))), "key", "id")
    assert {r.id: r.canonical for r in once.collect()} == {3: 1, 1: 1, 2: 2, 5: 2, 4: 4}


@pytest.mark.parametrize(("counts", "want"), [({0: 1, 1: 50, 2: 300, 3: 5000}, 2), ({0: 1, 1: 50, 2: 5000}, 1), ({0: 1, 1: 3000, 2: 9000}, 1), ({}, 1)])
def test_auto_depth(spark, counts, want):
    df = spark.createDataFrame([Row(depth=d, n=n) for d, n in counts.items()], "depth int, n long")
    assert hierarchy.auto_depth(df).first().depth == want


@pytest.mark.parametrize(("x", "want"), [(1.005, "1.00"), (2.675, "2.67"), (0.125, "0.12"), (-0.001, "-0.00"), (1e9, "1000000000.00")])
def test_printf(spark, x, want):
    assert value(spark, documents.printf_fixed(F.lit(x), 2)) == want


def test_documents_round_trip(spark, tree, tmp_path):
    index = hierarchy.tree_index(tree).withColumn("head", documents.tile_head(F.concat(F.lit("./"), "tile_id", F.lit(".glb"))))
    nested = documents.nest(index, 2)
    document = json.loads(nested.first().json)
    assert [c["content"]["uri"] if "content" in c else None for c in document["children"]] == [None, "./B.glb"]
    rows = indexes.index_rows(nested.select(F.col("tile_id").alias("tree_id"), F.expr("try_parse_json(json)").alias("tile")))
    assert sorted((r.depth, r.uri or "") for r in rows.collect()) == [(0, ""), (1, ""), (1, "./B.glb"), (2, "./A1.glb"), (2, "./A2.glb")]
    sinks.write_documents(nested.withColumnRenamed("tile_id", "name"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 1
    sinks.export_files(nested.select(F.lit("a/b.json").alias("name"), F.col("json").alias("content")), str(tmp_path / "files"))
    assert json.loads((tmp_path / "files/a/b.json").read_text()) == document


def test_documents_in_parts_round_trip(spark, tree):
    """Documents of a tree cut at a depth hold no more than a subtree there, and give all tiles back with their depths."""
    index = hierarchy.tree_index(tree).withColumns({"tree_id": F.col("path")[0], "head": documents.tile_head(F.concat(F.lit("./"), "tile_id", F.lit(".glb")))})
    parts = documents.parts(index, 1, 2)
    assert max(len(json.loads(r.json)["children"]) for r in parts.filter("depth = 0").collect()) == 0
    read = parts.select("tree_id", "depth", F.expr("parse_json(json)").alias("tile"))
    rows = indexes.index_rows(read, levels=2).collect()
    assert sorted((r.depth, r.uri or "") for r in rows) == [(0, ""), (1, ""), (1, "./B.glb"), (2, "./A1.glb"), (2, "./A2.glb")]
    assert {r.tree_id for r in rows} == {"R"}


def test_sub_indexes_are_streamed(spark, tree):
    """A cut-off subtree's document is the last step's row: nothing joins or copies it afterwards. Children keep their order; a tile without any has an empty list."""
    index = hierarchy.tree_index(tree).withColumn("head", documents.tile_head(F.concat(F.lit("./"), "tile_id", F.lit(".glb"))))
    whole = documents.sub_indexes(index, 1, 2)
    assert whole._jdf.queryExecution().optimizedPlan().nodeName() == "MapInArrow"
    got = {r.tile_id: json.loads(r.document)["root"]["children"] for r in whole.collect()}
    assert {k: [c["content"]["uri"] for c in v] for k, v in got.items()} == {"A": ["./A1.glb", "./A2.glb"], "B": []}
    assert {r.tile_id for r in documents.sub_indexes(index, 2, 2).collect()} == {"A1", "A2"}
    heads = spark.createDataFrame([("a", "A"), ("b", None), ("c", "C")], "tile_id string, head string")
    below = spark.createDataFrame([("y", "a", 2, "2"), ("x", "a", 10, "10"), ("z", "a", 3, None), ("w", "b", 1, "1"), ("v", "lost", 1, "1")], "tile_id string, parent_id string, ordinal long, json string")
    assert sorted(map(tuple, documents.streamed(heads, below, "j", "]}").collect())) == [("a", 'A,"children":[2,10]}'), ("b", None), ("c", 'C,"children":[]}')]


def test_a_document_is_made_of_sorted_pieces(spark, tree, tmp_path, monkeypatch):
    """Pieces at any depth give the nested document, and none holds more than a subtree there. A tile without a head takes all below it along; one without a parent is in no document."""
    index = hierarchy.tree_index(tree).withColumn("head", documents.tile_head(F.concat(F.lit("./"), "tile_id", F.lit(".glb")))).localCheckpoint()
    wide = spark.createDataFrame([("r", None, 0, 5, "{r"), ("q", None, 0, 10, "{q")] + [(f"c{i}", "r", 1, i, "{%d" % i if i != 3 else None) for i in range(12, 0, -1)] + [("l", "c7", 2, 1, "{l"), ("m", "c3", 2, 1, "{m"), ("n", "lost", 2, 1, "{n")], "tile_id string, parent_id string, depth int, ordinal long, head string")
    want = ['{r,"children":[' + ",".join('{%d,"children":[%s]}' % (i, '{l,"children":[]}' if i == 7 else "") for i in range(1, 13) if i != 3) + "]}", '{q,"children":[]}']
    for depth in range(3):
        assert documents.joined(documents.pieces(index, depth, 2)).first().document == documents.nest(index, 2).first().json
        parts = documents.pieces(wide, depth, 2)
        assert documents.joined(parts).first().document == ",".join(want)
        assert max(r.text.count("{") for r in parts.collect()) == (13, 2, 1)[depth]

    box = index.filter("depth = 0").select(*BOX, "ge")
    transform = [1.0, 0.0, 0.5]
    parts = documents.root_pieces(documents.pieces(index, 1, 2), box, transform)
    kids = documents.nest(index, 2, keep=("ordinal",))
    document = documents.root_index(kids, box, transform).first().document
    whole = documents.joined(parts)
    assert [r.document for r in whole.collect()] == [document]
    assert whole._jdf.queryExecution().optimizedPlan().nodeName() == "MapInArrow"
    sinks.export_pieces(parts, str(tmp_path / "out"), "a/b.json")
    assert [p.name for p in (tmp_path / "out/a").iterdir()] == ["b.json"]
    assert (tmp_path / "out/a/b.json").read_text() == document
    missing = documents.root_pieces(documents.pieces(index, 1, 2), box.withColumn("min_x", F.lit(None).cast("double")), transform)
    assert [r.document for r in documents.joined(missing).collect()] == [None]
    with pytest.raises(Exception, match="lacks a piece"):
        sinks.export_pieces(missing, str(tmp_path / "out"), "c.json")

    assert documents.checked(index) is index
    monkeypatch.setattr(documents, "LARGEST", len(document) - 1)
    with pytest.raises(Exception, match=f"more than the {len(document) - 1} bytes"):
        documents.joined(parts).collect()
    monkeypatch.setattr(documents, "LARGEST", len(document))
    assert documents.joined(parts).first().document == document


def test_a_root_document_that_no_value_holds_is_an_error_at_once(spark, tmp_path, monkeypatch):
    """It is neither nested nor cut, and its file is whole."""
    folder = "/root/testdata/sf0.001"
    document = plans_indexes.root_document(spark, folder).first().document
    monkeypatch.setattr(documents, "LARGEST", len(document) // 2)
    with pytest.raises(ValueError, match="export_pieces"):
        plans_indexes.root_document(spark, folder)
    plans_indexes.write_root_document(spark, folder, str(tmp_path))
    assert (tmp_path / "tileset.json").read_text() == document


def test_a_quadtree_index_is_made_of_sorted_pieces(spark, monkeypatch):
    """Fifteen levels are whole, their children by row and column, and one that no value holds is an error."""
    found = {(x, y): f"Tile_{x:+04d}_{y:+04d}" for x, y in [(-20, -20), (-19, -20), (-20, -19), (18, -20), (18, 400), (-3, 23056), (18, 23056)]}
    grid = spark.createDataFrame([(s, x, y, float(x), float(y), 0.0, x + 1.0, y + 1.0, 2.0, 3.0, i) for i, ((x, y), s) in enumerate(found.items())], "stem string, grid_x int, grid_y int, " + ", ".join(f"{c} double" for c in BOX) + ", ge double, ordinal long")
    top = quadtree.extent(grid).first().max_level
    nodes = quadtree.pyramid(grid).withColumn("uri", F.when(F.col("level") == 3, F.lit("./top/m.glb")))
    trees = grid.filter("grid_y <> 400").select("stem", F.format_string('{"ge":%s,"stem":"%s","children":[]}', F.col("ge").cast("string"), "stem").alias("json"))
    heads = {(r.level, r.grid_x, r.grid_y): r.head for r in nodes.withColumn("head", documents.tile_head()).collect()}
    leaves = {r.stem: r.json for r in trees.collect()}

    def nested(level, x, y):
        if level == 0:
            kids = sorted((s, leaves[s]) for (a, b), s in found.items() if s in leaves and a - x in (0, 1) and b - y in (0, 1))
            return json.loads(heads[0, x, y] + ',"children":[' + ",".join(j for _, j in kids) + "]}")
        half = 1 << level
        below = [(level - 1, a, b) for b in (y, y + half) for a in (x, x + half) if (level - 1, a, b) in heads]
        return json.loads(heads[level, x, y] + "}") | {"children": [nested(*k) for k in below]}

    def plain(tile):
        return {k: [plain(t) for t in v] if k == "children" else v for k, v in tile.items() if k != "content"}

    whole = documents.quadtree_index(nodes, top, grid, trees)
    assert whole._jdf.queryExecution().optimizedPlan().nodeName() == "MapInArrow"
    row = whole.first()
    assert (top, row.tile_id) == (14, "14_-20_-20")
    assert plain(json.loads(row.json)) == nested(top, -20, -20)
    assert row.json.count("./top/m.glb") == len([k for k in heads if k[0] == 3])
    monkeypatch.setattr(documents, "LARGEST", len(row.json) - 1)
    with pytest.raises(Exception, match=f"more than the {len(row.json) - 1} bytes"):
        documents.quadtree_index(nodes, top, grid, trees).collect()
    nothing = documents.quadtree_index(nodes.withColumn("ge", F.lit(None).cast("double")), top, grid, trees)
    assert [tuple(r) for r in nothing.collect()] == [("14_-20_-20", None)]


def test_closure_stops_at_cycles(spark):
    links = spark.createDataFrame([("a", "b", 0), ("b", "c", 0), ("c", "a", 0), ("a", "d", 1)], "parent string, child string, ordinal long")
    found = hierarchy.closure(links, spark.createDataFrame([("a",)], "id string"))
    assert sorted((r.id, r.depth) for r in found.collect()) == [("a", 0), ("b", 1), ("c", 2), ("d", 1)]


def test_tile_folder(spark, tmp_path):
    for name in ("Tile_+001_-002/Tile_+001_-002.osgb", "Tile_+001_-002/Tile_+001_-002_L15_0.osgb", "Other/Another.osgb"):
        path = tmp_path / "Data" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x")
    (tmp_path / "metadata.xml").write_text('<ModelMetadata version="1.0"><SRS>ENU:30.0,120.0</SRS><SRSOrigin>0,0,0</SRSOrigin></ModelMetadata>')
    (tmp_path / "config.json").write_text('{"x": 1.5, "max_lvl": 18}')
    assert [(r.stem, r.grid_x, r.grid_y) for r in files.scan_tiles(spark, str(tmp_path)).collect()] == [("Tile_+001_-002", 1, -2)]
    meta = files.read_metadata(spark, str(tmp_path))
    crs = meta.select(*(c.alias(n) for n, c in files.crs_columns("srs").items())).first()
    assert (crs.crs_kind, crs.crs_lat, crs.crs_lon) == ("ENU", 30.0, 120.0)
    config = files.read_config(spark, str(tmp_path / "config.json")).first()
    assert (config.x, config.y, config.max_lvl) == (1.5, None, 18)


def test_streaming_boxes_match_batch(spark, tree, tmp_path):
    tree.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(tree.schema).parquet(str(tmp_path / "in"))
    query = streaming_boxes(stream).writeStream.outputMode("complete").format("memory").queryName("rolled").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(map(tuple, spark.table("rolled").drop("tiles").collect())) == sorted(map(tuple, hierarchy.roll_up_boxes(tree).collect()))


def test_options_are_checked():
    with pytest.raises(ValueError, match="split_depth"):
        Options(split_depth=-1)

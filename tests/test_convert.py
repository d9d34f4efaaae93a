"""A folder of open scene files to an index and back, the split, the command line, geoid files, containers."""

from __future__ import annotations

import json
import struct

import numpy as np
import pytest

from stratile import convert
from stratile.__main__ import main, parser
from stratile.model import Options, Simplification
from stratile.operators import gltf, mesh
from stratile.sources import geoid, scenes


def scene(x, y, size, children=()):
    lines = [f"# child {c}" for c in children] + [f"v {x + i * size} {y + j * size} {i + j}" for j in (0, 1) for i in (0, 1)]
    return "\n".join([*lines, "f 1 2 4 3", "f 9 9 9", "v bad"])


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "in"
    (root / "Data").mkdir(parents=True)
    (root / "metadata.xml").write_text('<?xml version="1.0"?><ModelMetadata version="1"><SRS>ENU:30.5,114.25</SRS><SRSOrigin>0,0,0</SRSOrigin></ModelMetadata>')
    for n, (x, y) in {"Tile_+000_+000": (0, 0), "Tile_+001_+000": (10, 0), "Tile_+001_+001": (10, 10)}.items():
        d = root / "Data" / n
        d.mkdir()
        (d / f"{n}.obj").write_text(scene(x, y, 8, [f"{n}_L18_0.obj", "gone.obj"]))
        (d / f"{n}_L18_0.obj").write_text(scene(x, y, 4))
        (d / "stray.obj").write_text(scene(x, y, 1))
    (root / "Data" / "empty").mkdir()
    return root


def document(glb):
    magic, version, total, size = struct.unpack("<4sIII", glb[:16])
    assert (magic, version, total) == (b"glTF", 2, len(glb))
    return json.loads(glb[20 : 20 + size]), glb[28 + size :]


def test_folder_to_index_and_split(spark, folder, tmp_path):
    out = tmp_path / "out"
    convert.convert(spark, Options(str(folder), str(out)))
    index = json.loads((out / "tileset.json").read_text())
    assert len(index["root"]["transform"]) == 16
    kids = index["root"]["children"]
    assert len(kids) == 3
    assert sorted(k["content"]["uri"] for k in kids) == [f"./Data/{n}/{n}.glb" for n in ("Tile_+000_+000", "Tile_+001_+000", "Tile_+001_+001")]
    first = min(kids, key=lambda k: k["content"]["uri"])
    assert first["boundingVolume"]["box"] == [4, 4, 1, 4, 0, 0, 0, 4, 0, 0, 0, 1]
    assert [c["content"]["uri"] for c in first["children"]] == ["./Data/Tile_+000_+000/Tile_+000_+000_L18_0.glb"]
    assert (first["geometricError"], first["children"][0]["geometricError"]) == (0.2, 0)
    assert len(list(out.rglob("*.glb"))) == 6
    doc, body = document((out / "Data/Tile_+001_+000/Tile_+001_+000.glb").read_bytes())
    assert doc["accessors"][0]["max"] == [18, 8, 2]
    assert doc["accessors"][1]["count"] == 6

    assert convert.split(spark, str(out / "tileset.json"), str(tmp_path / "cut"), 1) == 1
    top = json.loads((tmp_path / "cut/tileset.json").read_text())
    refs = [k["content"]["uri"] for k in top["root"]["children"]]
    assert len(set(refs)) == 3
    parts = [json.loads((tmp_path / "cut" / r).read_text()) for r in refs]
    assert [p["root"]["content"]["uri"][:8] for p in parts] == ["../Data/"] * 3
    assert [[c["content"]["uri"].replace("../", "./") for c in p["root"]["children"]] for p in parts] == [[c["content"]["uri"] for c in k["children"]] for k in kids]
    with pytest.raises(ValueError, match="depth"):
        convert.split(spark, str(out / "tileset.json"), str(tmp_path / "cut2"), 9)


def test_split_json_and_top_levels(spark, folder, tmp_path):
    out = tmp_path / "out"
    convert.convert(spark, Options(str(folder), str(out), split_json=True, top_reconstruct=True, simplify=Simplification(ratio=1.0)))
    assert sorted(p.name for p in (out / "subtilesets").iterdir()) == [f"Tile_{n}.json" for n in ("+000_+000", "+001_+000", "+001_+001")]
    part = json.loads((out / "subtilesets/Tile_+000_+000.json").read_text())
    assert part["root"]["content"]["uri"] == "../Data/Tile_+000_+000/Tile_+000_+000.glb"
    top = json.loads((out / "tileset.json").read_text())["root"]
    assert top["content"]["uri"] == "./top/root.glb"
    assert len(top["children"]) == 3
    assert document((out / "top/root.glb").read_bytes())[0]["meshes"]


def test_errors(spark, folder, tmp_path):
    (folder / "metadata.xml").write_text("<ModelMetadata><SRS>EPSG:4326</SRS></ModelMetadata>")
    with pytest.raises(ValueError, match="4326"):
        convert.convert(spark, Options(str(folder), str(tmp_path / "x")))


def test_projected_folder_is_moved_to_the_local_plane(spark, folder, tmp_path):
    (folder / "metadata.xml").write_text("<ModelMetadata><SRS>EPSG:32650</SRS><SRSOrigin>500000,3300000,0</SRSOrigin></ModelMetadata>")
    convert.convert(spark, Options(str(folder), str(tmp_path / "x")))
    doc, _ = document((tmp_path / "x/Data/Tile_+001_+001/Tile_+001_+001.glb").read_bytes())
    assert doc["accessors"][0]["min"] == pytest.approx([10.004, 10.004, 0], abs=0.01)  # the scale on the central meridian is 0.9996


def test_command_line(spark, folder, tmp_path, capsys):
    assert main(["convert", "-i", str(folder), "-o", str(tmp_path / "o")]) == 0
    assert main(["split", "-i", str(tmp_path / "o/tileset.json"), "-o", str(tmp_path / "p")]) == 0
    assert "depth 2" in capsys.readouterr().out  # no depth has 100 tiles, so the deepest of at most 2000
    assert main(["split", "-i", str(tmp_path / "o/tileset.json"), "-o", str(tmp_path / "q"), "-d", "7"]) == 1
    with pytest.raises(SystemExit):
        parser().parse_args(["convert"])


def test_models_of_all_kinds():
    p = np.arange(24, dtype=np.float32).reshape(8, 3)
    g = gltf.Geometry(p, (gltf.Primitive("QUADS", np.arange(8)), gltf.Primitive("QUAD_STRIP", None, 0, 6), gltf.Primitive("LINES", None, 2, 4), gltf.Primitive("POLYGON", np.arange(5)), gltf.Primitive("TRIANGLES", np.array([0, 1, 2]))), np.zeros((8, 3)), p[:, :2], 0)
    doc, body = document(gltf.build([g], [("image/png", b"picture")]))
    prims = doc["meshes"][0]["primitives"]
    assert [x["mode"] for x in prims] == [4, 4, 1, 4]
    assert prims[0]["attributes"] == prims[1]["attributes"] == prims[3]["attributes"] != prims[2]["attributes"]
    read = lambda i, kind: np.frombuffer(body, kind, doc["bufferViews"][doc["accessors"][i]["bufferView"]]["byteLength"] // np.dtype(kind).itemsize, doc["bufferViews"][doc["accessors"][i]["bufferView"]]["byteOffset"])
    assert read(prims[0]["indices"], "u1").tolist() == [0, 1, 2, 0, 2, 3, 4, 5, 6, 4, 6, 7]
    assert read(prims[1]["indices"], "u1").tolist() == [0, 1, 2, 1, 3, 2, 2, 3, 4, 3, 5, 4]
    assert read(prims[2]["attributes"]["POSITION"], "<f4").tolist() == p[2:6].ravel().tolist()
    assert read(prims[0]["attributes"]["NORMAL"], "<f4").tolist() == [0, 0, 1] * 8
    assert all(v["byteOffset"] % 8 == 0 for v in doc["bufferViews"])
    assert [x["material"] for x in prims] == [1] * 4
    assert gltf.build([gltf.Geometry(p[:0], (gltf.Primitive("POINTS", None, 0, 1),))]) is None


def test_thinning_and_images():
    p, at = np.random.default_rng(0).random((900, 3)), np.arange(900)
    points, corners = gltf.clustered(p, at, 0.01)
    assert len(points) <= gltf.MIN_SIDE**3
    assert corners.max() < len(points)
    assert np.array_equal(gltf.clustered(p, at, 1.0)[1], at)
    raw = bytes([3, 2, 1, 6, 5, 4, 0, 0, 9, 8, 7, 12, 11, 10, 0, 0])
    image = mesh.unpacked(raw, 2, 2, "BGR", 8)
    assert image.tolist() == [[[1, 2, 3, 255], [4, 5, 6, 255]], [[7, 8, 9, 255], [10, 11, 12, 255]]]
    assert mesh.downsampled(image, 1).tolist() == [[[6, 7, 8, 255]]]
    assert mesh.downsampled(image, 2) is image
    with pytest.raises(ValueError, match="format"):
        mesh.unpacked(raw, 2, 2, "XYZ")


def test_scene_text():
    assert scenes.parse_obj("v 0 0 0\nv 1 0 0\nv 1 1 0\nf 1/1 2/2 -1/3\n# child a.obj\nf 1 2\nf x y z") == (["a.obj"], [0, 0, 0, 1, 0, 0, 1, 1, 0], [0, 1, 2])


def test_geoid_files(spark, tmp_path):
    values = np.arange(4 * 3, dtype=">u2")
    (tmp_path / "egm96-5.pgm").write_bytes(b"P5\n# Offset -10\n# Scale 0.5\n4 3\n65535\n" + values.tobytes())
    grid = geoid.load_geoid(spark, "EGM96", str(tmp_path))
    assert sorted((r.gy, r.gx, r.n) for r in grid.collect()) == [(i // 4, i % 4, i * 0.5 - 10) for i in range(12)]
    points = spark.createDataFrame([(1, 0.0, 90.0), (2, 45.0, 45.0), (3, -90.0, -90.0)], "id long, lon double, lat double")
    assert {r.id: r.n for r in geoid.undulations(points, grid, 4, cubic=False).collect()} == {1: -10.0, 2: -8.75, 3: -4.5}
    assert {r.id: r.n for r in geoid.undulations(points, grid.filter("gx <> 1"), 4, cubic=False).collect()}[2] is None
    assert geoid.load_geoid(spark, "NONE") is None
    assert geoid.geoid_folder({"GEOGRAPHICLIB_DATA": "/d"}) == "/d/geoids"
    with pytest.raises(ValueError, match="unknown"):
        geoid.load_geoid(spark, "X")

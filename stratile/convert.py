"""Conversion of a tile folder to models and a tile index, and the split of an index into files.

Each step is a DataFrame: scene files are read once, trees are closed over their child names, vertices are corrected by one affine
map a tile, models are built where their vertices are, boxes and errors roll up, documents nest level by level. The driver holds
the reference frame and the root document alone.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import boxes, geo, text
from .model import BOX, Options
from .operators import documents, gltf, hierarchy, quadtree
from .sinks import export_files
from .sources import files, indexes, scenes
from .sources.checkpoint import cut

MODEL = "content binary, " + ", ".join(f"{c} double" for c in BOX)
MODEL_FIELDS = [("content", pa.binary()), *((c, pa.float64()) for c in BOX)]


@dataclass(frozen=True)
class Frame:
    """The local origin, and how points of the source get to its plane."""

    kind: str
    code: int | None
    origin: tuple[float, float, float]
    lon: float
    lat: float
    height: float

    def image(self, x, y, z):
        lit = lambda v: F.lit(v)
        return geo.local_plane(lit(self.kind), lit(self.code).cast("int"), tuple(map(lit, self.origin)), (x, y, z), tuple(map(lit, (self.lon, self.lat, self.height))), lit(0.0))


def reference_frame(metadata: DataFrame, options: Options) -> Frame:
    """The frame of a folder's metadata (one row); options state a centre where the metadata has none."""
    part = lambda i: F.coalesce(F.get(F.split("srs_origin", ","), F.lit(i)).try_cast("double"), F.lit(0.0))
    row = metadata.select(*(c.alias(n) for n, c in files.crs_columns("srs").items()), *(part(i).alias(f"o{i}") for i in range(3))).limit(1).collect()
    if not row or row[0].crs_kind == "UNSUPPORTED":
        raise ValueError("the metadata has no reference system that can be read")
    r = row[0]
    origin = (r.o0, r.o1, r.o2)
    if r.crs_kind == "ENU":
        return Frame("ENU", None, origin, r.crs_lon or 0.0, r.crs_lat or 0.0, 0.0)
    stated = tuple(map(F.lit, (options.lon, options.lat, options.alt)))
    found = geo.frame_origin(F.lit(r.crs_kind), F.lit(r.crs_code).cast("int"), tuple(map(F.lit, origin)), stated, F.lit(0.0), F.lit(False))
    lon, lat, height = metadata.sparkSession.range(1).select(*found).first()
    if lon is None:
        raise ValueError(f"no projection for {r.crs_kind}:{r.crs_code} is built in")
    return Frame(r.crs_kind, r.crs_code, origin, lon, lat, height)


def tile_trees(found: DataFrame, stems: DataFrame, suffix: str, max_level: int | None = None) -> DataFrame:
    """tree_id, tile_id, parent_id, depth, path, ordinal, type of the files that are reached from the folders' own files. Names that lead to no file end their branch."""
    known = found.select("file")
    links = hierarchy.lod_children(found.select("file", "child_files")).join(known.withColumnRenamed("file", "child"), "child", "left_semi")
    roots = stems.select(F.concat(F.lit("Data/"), "stem", F.lit("/"), "stem", F.lit(f".{suffix}")).alias("id"))
    tiles = hierarchy.closure(links, roots)
    named = tiles.select(F.split(F.col("path")[0], "/")[1].alias("tree_id"), F.col("id").alias("tile_id"), F.get("path", F.size("path") - 2).alias("parent_id"), "depth", "path", "ordinal", F.lit(1).alias("type"))
    if max_level is None:
        return named
    levels = F.transform("path", lambda p: F.coalesce(text.lod_level(text.base_name(p)), F.lit(0)))
    return hierarchy.prune_levels(named.withColumn("levels", levels), "levels", F.lit(max_level)).drop("levels")


def moved(points: np.ndarray, images: np.ndarray) -> np.ndarray:
    """Points under the least-squares affine map of their box: images of its corners, x the fastest; see geo.affine_fit."""
    low, high = points.min(axis=0), points.max(axis=0)
    high_side = np.arange(8)[:, None] >> np.arange(3) & 1 == 1
    rise = np.stack([images[high_side[:, k]].mean(axis=0) - images[~high_side[:, k]].mean(axis=0) for k in range(3)])
    extent = high - low
    slopes = np.where(extent[:, None] > 0, rise / np.where(extent > 0, extent, 1)[:, None], 0)
    return images.mean(axis=0) + (points - (low + high) / 2) @ slopes


def models(found: DataFrame, frame: Frame, unlit: bool = True, ratio: float = 1.0) -> DataFrame:
    """file, content, box of each scene's model; scenes without triangles have neither. Vertices of projected systems are moved by their box's affine map."""
    flat = lambda k, f: f(F.transform(F.sequence(F.lit(k + 1), F.size("positions"), F.lit(3)), lambda i: F.element_at("positions", i.cast("int"))))
    sized = found.filter(F.size("positions") >= 3).withColumns({f"{n}_{a}": flat(k, f) for k, a in enumerate("xyz") for n, f in (("min", F.array_min), ("max", F.array_max))})
    if frame.kind in ("EPSG", "WKT"):  # the map is evaluated once a corner, by one expression for all of them
        corners = F.array(*(F.struct(*(F.col(f"{'max' if i >> k & 1 else 'min'}_{a}").alias(a) for k, a in enumerate("xyz"))) for i in range(8)))
        images = F.flatten(F.transform(corners, lambda c: F.array(*frame.image(c["x"], c["y"], c["z"]))))
    else:
        images = F.lit(None).cast("array<double>")
    schema = pa.schema([("file", pa.string()), *MODEL_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, positions, indices, images_ = (batch.column(k)[i].as_py() for k in range(4))
                points = np.array(positions, np.float64).reshape(-1, 3)
                if images_ is not None:
                    points = moved(points, np.array(images_).reshape(8, 3))
                points, at = gltf.clustered(points, np.array(indices, np.int64), ratio)
                content = gltf.build([gltf.Geometry(points, (gltf.Primitive("TRIANGLES", at),))], unlit=unlit)
                box = [None] * 6 if content is None else [*points.min(axis=0).tolist(), *points.max(axis=0).tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((name, content, *box), schema, strict=True)], schema=schema)

    return sized.select("file", "positions", "indices", images.alias("images")).mapInArrow(run, f"file string, {MODEL}")


def convert(spark: SparkSession, options: Options, suffix: str = "obj") -> None:
    """Writes the models, tileset.json and, if asked for, an index file for each tree. A folder without metadata, reference system or tiles is an error."""
    metadata = files.read_metadata(spark, options.input)
    frame = reference_frame(metadata, options)
    stems = files.scan_tiles(spark, options.input, suffix)
    found = scenes.read_scenes(spark, options.input, suffix)
    built = cut(models(found, frame, options.unlit, options.simplify.ratio if options.simplify_meshes else 1.0).filter("content is not null"))
    tiles = tile_trees(found, stems, suffix, options.max_level).join(built.select("file", *BOX).withColumnRenamed("file", "tile_id"), "tile_id", "left")
    index = cut(hierarchy.tree_index(tiles))
    if not index.limit(1).count():
        raise ValueError(f"{options.input} has no tiles")
    output = F.regexp_replace("file", rf"\.{suffix}$", ".glb")
    export_files(built.join(index.select(F.col("tile_id").alias("file")), "file").select(output.alias("name"), "content"), options.output)
    uri = F.concat(F.lit("./"), F.regexp_replace("tile_id", rf"\.{suffix}$", ".glb"))
    own = F.col("min_x").isNotNull()
    content_files = built.select(F.col("file").alias("tile_id"), F.lit(1).alias("has_content"))
    headed = index.join(content_files, "tile_id", "left").withColumn("type", F.coalesce("has_content", F.lit(0))).withColumn("head", documents.tile_head(documents.names.sub_index_uri(uri) if options.split_json else uri))
    deepest = headed.agg(F.max("depth").alias("d")).first().d
    nested = cut(documents.nest(headed, deepest).join(headed.filter("depth = 0").select("tile_id", F.col("tree_id").alias("stem"), "ordinal", "ge", *BOX), "tile_id").filter(own))
    kids = nested
    if options.split_json:
        envelope = F.concat(F.lit('{"asset":{"version":"1.1"},"geometricError":'), documents.printf_fixed(F.col("ge"), 2), F.lit(',"root":'), "json", F.lit("}"))
        export_files(nested.select(F.concat(F.lit("subtilesets/"), "stem", F.lit(".json")).alias("name"), envelope.alias("content")), options.output)
        kids = documents.tree_references(nested).join(nested.select("stem", "ordinal"), "stem")
    padded = nested.select(*(c.alias(n) for n, c in boxes.padded(0.2).items()), "ge")
    box = padded.agg(*[(F.min if c.startswith("min") else F.max)(c).alias(c) for c in BOX], F.max("ge").alias("ge"))
    lifted = geo.transform_height(F.lit(frame.height), F.lit(None).cast("double"), F.lit(options.alt), F.lit(0.0))
    transform = spark.range(1).select(geo.enu_to_ecef(F.lit(frame.lon), F.lit(frame.lat), lifted).alias("m")).first().m
    if options.top_reconstruct:
        root = _top_levels(stems, nested, built, options)
        document = root.select(F.concat(F.lit('{"asset":{"version":"1.1","gltfUpAxis":"Z"},"geometricError":0,"root":{"transform":'), F.lit("[" + ",".join(map(repr, transform)) + "],"), F.expr("substring(json, 2)"), F.lit("}")).alias("content"))
    else:
        document = documents.root_index(kids, box, transform).select(F.col("document").alias("content"))
    export_files(document.select(F.lit("tileset.json").alias("name"), "content"), options.output)


def merged(meshes: DataFrame, level: int, base: float) -> DataFrame:
    """key, positions, indices of all meshes (key, positions, indices) of a key put together and thinned by the level's ratio. Rows are dealt and sorted by key and streamed."""
    ratio = max(0.01, base * 0.25 ** (level + 1))
    schema = pa.schema([("key", pa.string()), ("positions", pa.list_(pa.float64())), ("indices", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, points, at, n = None, [], [], 0

        def close() -> pa.RecordBatch:
            p, i = gltf.clustered(np.concatenate(points), np.concatenate(at), ratio)
            return pa.RecordBatch.from_arrays([pa.array([last]), pa.array([p.astype(np.float64).ravel()], schema[1].type), pa.array([i.astype(np.int32)], schema[2].type)], schema=schema)

        for batch in batches:
            for i, key in enumerate(batch.column("key").to_pylist()):
                if points and key != last:
                    yield close()
                    points, at, n = [], [], 0
                last = key
                points.append(np.array(batch.column("positions")[i].as_py(), np.float64).reshape(-1, 3))
                at.append(np.array(batch.column("indices")[i].as_py(), np.int64) + n)
                n += len(points[-1])
        if points:
            yield close()

    return meshes.select("key", "positions", "indices").repartition("key").sortWithinPartitions("key").mapInArrow(run, "key string, positions array<double>, indices array<int>")


def merged_levels(cells: DataFrame, meshes: DataFrame, base: float = 0.5) -> DataFrame:
    """level, grid_x, grid_y, positions, indices of every pyramid node with a mesh below (cells: stem, grid_x, grid_y; meshes: stem, positions, indices).

    A level is merged from the thinned meshes of the one below, so each is read once and the top gathers no raw leaves.
    """
    e = quadtree.extent(cells).first()
    here = cells.join(meshes, "stem").select("grid_x", "grid_y", "positions", "indices")
    found = None
    for level in range(max(0, (e.max_level if e.n else -1)) + 1):
        size = 2 << level
        node = lambda c, o: (F.floor((F.col(c) - o) / size) * size + o).cast("int")  # noqa: B023, E731
        keyed = here.select(F.concat_ws("_", node("grid_x", e.x0), node("grid_y", e.y0)).alias("key"), "positions", "indices")
        part = lambda i: F.split("key", "_")[i].cast("int")
        here = cut(merged(keyed, level, base).select(part(0).alias("grid_x"), part(1).alias("grid_y"), "positions", "indices"))
        rows = here.select(F.lit(level).alias("level"), "*")
        found = rows if found is None else found.unionByName(rows)
    return found


def _top_levels(stems: DataFrame, nested: DataFrame, built: DataFrame, options: Options) -> DataFrame:
    """tile_id, json of the pyramid over the trees, its merged models written below top/."""
    cells = quadtree.build_grid(stems.join(nested.select("stem", "ge", *BOX), "stem").withColumn("ordinal", F.col("stem")))
    top = quadtree.extent(cells).first().max_level
    if top is None or top < 0:
        raise ValueError("the pyramid needs two cells with grid coordinates at least")
    found = scenes.read_scenes(stems.sparkSession, options.input).select(F.split("file", "/")[1].alias("stem"), "file", "positions", "indices")
    roots = found.filter(F.col("file") == F.concat(F.lit("Data/"), "stem", F.lit("/"), "stem", F.lit(".obj"))).filter(F.size("indices") > 0)
    name = F.concat(F.lit("top/"), text.mesh_name(F.col("level"), F.col("grid_x"), F.col("grid_y"), F.lit(top)))
    levels = cut(merged_levels(cells, roots, options.simplify.ratio).withColumn("file", name).filter(F.size("indices") > 0))
    plain = Frame("ENU", None, (0.0, 0.0, 0.0), 0.0, 0.0, 0.0)
    export_files(models(levels, plain, options.unlit).filter("content is not null").select(F.col("file").alias("name"), "content"), options.output)
    nodes = quadtree.pyramid(cells).join(levels.select("level", "grid_x", "grid_y", F.concat(F.lit("./"), "file").alias("uri")), ["level", "grid_x", "grid_y"], "left")
    trees = documents.tree_references(nested) if options.split_json else nested.select("stem", "json")
    return documents.quadtree_index(nodes, top, cells, trees)


def split(spark: SparkSession, path: str, output: str, depth: int | None = None, low: int = 100, high: int = 2000) -> int:
    """Cuts an index document at a depth (None: chosen by the number of tiles) into a main document and parts; gives the depth."""
    rows = cut(indexes.read_index(spark, path))
    if depth is None:
        depth = hierarchy.auto_depth(hierarchy.depth_histogram(rows), low, high).first().depth
    main, parts = documents.split_documents(rows, depth)
    export_files(main.select(F.lit(os.path.basename(path)).alias("name"), F.col("document").alias("content")), output)
    export_files(parts.select(F.concat(F.lit("subtilesets/"), "name").alias("name"), F.col("document").alias("content")), output)
    return depth

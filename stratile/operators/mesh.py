"""Mesh steps: triangulation, normals, index widths, texture sizes, vertex clustering, GLB and B3DM containers.

Compressed mesh and texture codecs need native libraries and are out of scope; vertex clustering stands in for edge
collapse and is approximate.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORT_NORMAL, UNIT_TOLERANCE = 1e-4, 1e-4


def triangulate_quads(indices: str) -> Column:
    """Quads a b c d as a b c, a c d; null unless the length is a multiple of four."""
    four = f"slice({indices}, q * 4 + 1, 4)"
    return F.expr(f"""case when size({indices}) % 4 = 0 and size({indices}) > 0 then flatten(transform(sequence(0, cast(size({indices}) / 4 as int) - 1),
        q -> array({four}[0], {four}[1], {four}[2], {four}[0], {four}[2], {four}[3]))) end""")


def triangulate_strip(indices: str) -> Column:
    """Quad strip rungs (a b), (c d) as a b c, b d c; null unless the length is even and at least four."""
    four = f"slice({indices}, q * 2 + 1, 4)"
    return F.expr(f"""case when size({indices}) % 2 = 0 and size({indices}) >= 4 then flatten(transform(sequence(0, cast(size({indices}) / 2 as int) - 2),
        q -> array({four}[0], {four}[1], {four}[2], {four}[1], {four}[3], {four}[2]))) end""")


def index_width(largest: Column) -> Column:
    """Bytes of the narrowest unsigned index type."""
    return F.when(largest <= 255, 1).when(largest <= 65535, 2).otherwise(4)


def fixed_normal(x: Column, y: Column, z: Column) -> tuple[Column, ...]:
    """Unit normals: a vanishing one points up, others are scaled unless they are unit already."""
    length = F.sqrt(x * x + y * y + z * z)
    keep = F.abs(length - 1.0) <= UNIT_TOLERANCE
    pick = lambda c, up: F.when(length < SHORT_NORMAL, F.lit(up)).when(keep, c).otherwise(c / length)
    return pick(x, 0.0), pick(y, 0.0), pick(z, 1.0)


def texture_size(w: Column, h: Column, limit: int) -> tuple[Column, Column]:
    """Sizes scaled to the limit, truncated, at least 1."""
    longest = F.greatest(w, h)
    scaled = lambda c: F.when(longest > limit, F.greatest(F.lit(1), F.floor(c * (F.lit(float(limit)) / longest)).cast("int"))).otherwise(c)
    return scaled(w), scaled(h)


def quantized(value: Column, low: Column, high: Column, bits: int) -> Column:
    """Grid step of a value within its range; the midpoint rounds up."""
    return F.when(high > low, F.floor((value - low) / (high - low) * float((1 << bits) - 1) + 0.5)).otherwise(0).cast("long")


def cluster_vertices(vertices: DataFrame, group: str, cell: float) -> DataFrame:
    """group, cluster_x/y/z, x, y, z, n: the mean vertex of each grid cell."""
    at = [F.floor(F.col(a) / cell).cast("long").alias(f"cluster_{a}") for a in "xyz"]
    return vertices.groupBy(group, *at).agg(*(F.avg(a).alias(a) for a in "xyz"), F.count("*").alias("n"))


def smooth_normals(triangles: DataFrame) -> DataFrame:
    """geom, vertex and the normalised sum of face normals (triangles: geom, a, b, c and corner columns ax ... cz)."""
    u = [F.col(f"b{k}") - F.col(f"a{k}") for k in "xyz"]
    v = [F.col(f"c{k}") - F.col(f"a{k}") for k in "xyz"]
    n = [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]
    faces = triangles.select("geom", F.explode(F.array("a", "b", "c")).alias("vertex"), *(c.alias(f"n{k}") for c, k in zip(n, "xyz", strict=True)))
    total = faces.groupBy("geom", "vertex").agg(*(F.sum(f"n{k}").alias(f"n{k}") for k in "xyz"))
    x, y, z = fixed_normal(F.col("nx"), F.col("ny"), F.col("nz"))
    return total.select("geom", "vertex", x.alias("nx"), y.alias("ny"), z.alias("nz"))


def glb(positions: np.ndarray, indices: np.ndarray, unlit: bool = True) -> bytes:
    """A binary glTF of one triangle mesh: 12-byte header, JSON chunk, data chunk, both padded to four bytes."""
    positions = np.ascontiguousarray(positions, "<f4").reshape(-1, 3)
    largest = int(indices.max()) if len(indices) else 0
    kind, code = (np.uint8, 5121) if largest <= 255 else (np.uint16, 5123) if largest <= 65535 else (np.uint32, 5125)
    index_bytes = np.asarray(indices).astype(kind).tobytes()
    index_bytes += b"\0" * (-len(index_bytes) % 4)
    body = index_bytes + positions.tobytes()
    material = {"pbrMetallicRoughness": {"baseColorFactor": [0.75, 0.75, 0.75, 1.0], "metallicFactor": 0.0, "roughnessFactor": 1.0}} | ({"extensions": {"KHR_materials_unlit": {}}} if unlit else {})
    document = {
        "asset": {"version": "2.0", "generator": "stratile"},
        "scene": 0,
        "scenes": [{"nodes": [0]}],
        "nodes": [{"mesh": 0}],
        "meshes": [{"primitives": [{"attributes": {"POSITION": 1}, "indices": 0, "material": 0, "mode": 4}]}],
        "materials": [material],
        "buffers": [{"byteLength": len(body)}],
        "bufferViews": [{"buffer": 0, "byteOffset": 0, "byteLength": len(index_bytes), "target": 34963}, {"buffer": 0, "byteOffset": len(index_bytes), "byteLength": positions.nbytes, "target": 34962}],
        "accessors": [
            {"bufferView": 0, "componentType": code, "count": len(indices), "type": "SCALAR"},
            {"bufferView": 1, "componentType": 5126, "count": len(positions), "type": "VEC3", "min": positions.min(axis=0).tolist() if len(positions) else [0.0] * 3, "max": positions.max(axis=0).tolist() if len(positions) else [0.0] * 3},
        ],
    } | ({"extensionsUsed": ["KHR_materials_unlit"]} if unlit else {})
    head = json.dumps(document, separators=(",", ":")).encode()
    head += b" " * (-len(head) % 4)
    chunks = struct.pack("<I4s", len(head), b"JSON") + head + struct.pack("<I4s", len(body), b"BIN\0") + body
    return struct.pack("<4sII", b"glTF", 2, 12 + len(chunks)) + chunks


def b3dm(model: bytes) -> bytes:
    """A batched model: 28-byte header, feature and batch documents padded so that each part is aligned to eight, the model."""
    feature, batch = b'{"BATCH_LENGTH":1}', b'{"batchId":[0],"name":["mesh_0"]}'
    feature += b" " * (-(28 + len(feature)) % 8)
    batch += b" " * (-len(batch) % 8)
    model += b"\0" * (-len(model) % 8)
    return struct.pack("<4sIIIIII", b"b3dm", 1, 28 + len(feature) + len(batch) + len(model), len(feature), 0, len(batch), 0) + feature + batch + model


def tile_models(vertices: DataFrame, group: str, wrap: bool = False) -> DataFrame:
    """group, content of each group's points as a triangle fan. Rows are dealt by group, sorted and streamed: a task holds one group at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        last, keys, made = None, [], []

        def close() -> None:
            points = np.concatenate(held)
            n = max(0, len(points) - 2)
            fan = np.stack([np.zeros(n, np.int64), np.arange(1, n + 1), np.arange(2, n + 2)], axis=1).ravel()
            content = glb(points, fan)
            keys.append(last)
            made.append(b3dm(content) if wrap else content)
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_pylist()
            points = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.float32) for i in (1, 2, 3)], axis=1)
            edges = [0, *(i for i in range(1, len(own)) if own[i] != own[i - 1]), len(own)]
            for a, b in zip(edges, edges[1:]):
                if held and own[a] != last:
                    close()
                last = own[a]
                held.append(points[a:b])
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(made, pa.binary())], names=[group, "content"])
            keys.clear()
            made.clear()
        if held:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(made, pa.binary())], names=[group, "content"])

    rows = vertices.select(group, "x", "y", "z", "ordinal").repartition(group).sortWithinPartitions(group, "ordinal").drop("ordinal")
    return rows.mapInArrow(run, f"`{group}` {dict(vertices.dtypes)[group]}, content binary")


def container_layout(content: Column) -> dict[str, Column]:
    """What a GLB container says of itself: magic, version, whether its length is right, indices, positions, index type, data bytes."""
    number = lambda at: F.conv(F.concat(*(F.hex(F.substring(content, at + k, 1)) for k in (3, 2, 1, 0))), 16, 10).cast("long")
    document = content.substr(F.lit(21), number(13).cast("int")).cast("string")
    field = lambda path: F.get_json_object(document, path).cast("long")
    return {
        "magic": F.substring(content, 1, 4).cast("string"),
        "version": number(5),
        "whole": number(9) == F.length(content),
        "indices": field("$.accessors[0].count"),
        "positions": field("$.accessors[1].count"),
        "component": field("$.accessors[0].componentType"),
        "data": field("$.buffers[0].byteLength"),
    }


def unpacked(raw: bytes, width: int, height: int, pixels: str, row_bytes: int = 0) -> np.ndarray:
    """height x width x 4 bytes (red, green, blue, alpha) of an image in RGBA, BGRA, RGB or BGR whose rows take row_bytes (0: no padding)."""
    depth = len(pixels)
    if sorted(pixels) not in (sorted("RGB"), sorted("RGBA")):
        raise ValueError(f"unknown pixel format {pixels}")
    step = row_bytes or width * depth
    rows = np.frombuffer(raw, np.uint8, step * (height - 1) + width * depth)
    rows = np.concatenate([rows, np.zeros(step * height - len(rows), np.uint8)]).reshape(height, step)[:, : width * depth].reshape(height, width, depth)
    out = np.full((height, width, 4), 255, np.uint8)
    for k, channel in enumerate("RGBA"):
        if channel in pixels:
            out[:, :, k] = rows[:, :, pixels.index(channel)]
    return out


def downsampled(image: np.ndarray, limit: int) -> np.ndarray:
    """The image scaled so that no side is over the limit: each pixel is the mean of those it covers."""
    height, width = image.shape[:2]
    longest = max(height, width)
    if longest <= limit:
        return image
    h, w = (max(1, int(n * (limit / longest))) for n in (height, width))
    rows, columns = (np.arange(n) * full // n for n, full in ((h, height), (w, width)))
    total = np.add.reduceat(np.add.reduceat(image.astype(np.float64), rows, axis=0), columns, axis=1)
    area = np.diff([*rows, height])[:, None, None] * np.diff([*columns, width])[None, :, None]
    return np.floor(total / area + 0.5).astype(np.uint8)

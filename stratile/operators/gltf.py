"""Binary glTF of whole geometries: primitives of all modes, narrow indices, normals, texture coordinates, images.

A model is built in numpy where its geometries are: one tile's mesh fits a task. Compressed meshes and textures need
native codecs and are out of scope.
"""

from __future__ import annotations

import json
import struct
from dataclasses import dataclass

import numpy as np

from .mesh import SHORT_NORMAL, UNIT_TOLERANCE

#: Modes by name (fixed values); quads become triangles.
MODES = {"POINTS": 0, "LINES": 1, "LINE_LOOP": 2, "LINE_STRIP": 3, "TRIANGLES": 4, "TRIANGLE_STRIP": 5, "TRIANGLE_FAN": 6}
ARRAY, ELEMENTS = 34962, 34963
#: Cells along the longest side that thinning leaves at least.
MIN_SIDE = 4
GREY = (0.75, 0.75, 0.75, 1.0)


@dataclass(frozen=True)
class Primitive:
    """indices, or a run (first, count) of the geometry's vertices."""

    mode: str
    indices: np.ndarray | None = None
    first: int = 0
    count: int = 0


@dataclass(frozen=True)
class Geometry:
    """Vertices with optional normals and texture coordinates, primitives, and the number of an image (-1: none)."""

    positions: np.ndarray
    primitives: tuple[Primitive, ...]
    normals: np.ndarray | None = None
    uvs: np.ndarray | None = None
    image: int = -1


def fixed_normals(normals: np.ndarray) -> np.ndarray:
    """Unit normals: vanishing ones point up, others are scaled unless they are unit already."""
    n = np.asarray(normals, np.float64).reshape(-1, 3)
    length = np.sqrt((n * n).sum(axis=1))
    off = (np.abs(length - 1) > UNIT_TOLERANCE) & (length >= SHORT_NORMAL)
    n[off] /= length[off, None]
    n[length < SHORT_NORMAL] = (0, 0, 1)
    return n.astype(np.float32)


def triangles(p: Primitive) -> tuple[str, np.ndarray | None] | None:
    """Mode and indices as they are written; None for an unknown mode or quads that don't come out even."""
    if p.mode in MODES:
        return p.mode, p.indices
    at = np.arange(p.first, p.first + p.count) if p.indices is None else np.asarray(p.indices)
    if p.mode == "QUADS" and len(at) and len(at) % 4 == 0:
        return "TRIANGLES", at.reshape(-1, 4)[:, [0, 1, 2, 0, 2, 3]].ravel()
    if p.mode == "QUAD_STRIP" and len(at) >= 4 and len(at) % 2 == 0:
        rungs = np.arange(0, len(at) - 2, 2)[:, None] + np.array([0, 1, 2, 1, 3, 2])
        return "TRIANGLES", at[rungs].ravel()
    return None


def clustered(positions: np.ndarray, indices: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean vertices of grid cells, about ratio of them, with the triangles that keep three corners: a stand-in for edge collapse, and approximate."""
    points = np.asarray(positions, np.float64).reshape(-1, 3)
    if not len(points) or ratio >= 1:
        return points.astype(np.float32), np.asarray(indices, np.int64)
    low, extent = points.min(axis=0), float(np.ptp(points, axis=0).max())
    side = max(MIN_SIDE, int(np.sqrt(len(points) * ratio)))
    cell = np.minimum(((points - low) * (side / extent)).astype(np.int64), side - 1) if extent else np.zeros(points.shape, np.int64)
    _, at = np.unique(cell @ np.array([1, 1 << 21, 1 << 42]), return_inverse=True)
    n = np.bincount(at)
    means = np.stack([np.bincount(at, points[:, k]) / n for k in range(3)], axis=1)
    corners = at[np.asarray(indices, np.int64)].reshape(-1, 3)
    whole = (corners[:, 0] != corners[:, 1]) & (corners[:, 1] != corners[:, 2]) & (corners[:, 0] != corners[:, 2])
    return means.astype(np.float32), corners[whole].ravel()


class _Writer:
    def __init__(self) -> None:
        self.body, self.views, self.accessors = bytearray(), [], []

    def view(self, data: bytes, target: int | None) -> int:
        self.body += b"\0" * (-len(self.body) % 8)
        self.views.append({"buffer": 0, "byteOffset": len(self.body), "byteLength": len(data)} | ({"target": target} if target else {}))
        self.body += data
        return len(self.views) - 1

    def accessor(self, data: np.ndarray, kind: str, component: int, target: int, bounds: bool = False) -> int:
        found = {"bufferView": self.view(data.tobytes(), target), "componentType": component, "count": len(data), "type": kind}
        if bounds:
            found |= {"min": data.min(axis=0).tolist(), "max": data.max(axis=0).tolist()}
        self.accessors.append(found)
        return len(self.accessors) - 1

    def index(self, at: np.ndarray) -> int:
        largest = int(at.max()) if len(at) else 0
        kind, code = ("<u1", 5121) if largest <= 255 else ("<u2", 5123) if largest <= 65535 else ("<u4", 5125)
        return self.accessor(np.asarray(at).astype(kind), "SCALAR", code, ELEMENTS)

    def attributes(self, g: Geometry, part: slice) -> dict[str, int]:
        positions = np.ascontiguousarray(g.positions, "<f4").reshape(-1, 3)[part]
        found = {"POSITION": self.accessor(positions, "VEC3", 5126, ARRAY, True)}
        if g.normals is not None:
            found["NORMAL"] = self.accessor(fixed_normals(g.normals)[part].astype("<f4"), "VEC3", 5126, ARRAY, True)
        if g.uvs is not None:
            found["TEXCOORD_0"] = self.accessor(np.ascontiguousarray(g.uvs, "<f4").reshape(-1, 2)[part], "VEC2", 5126, ARRAY, True)
        return found


def build(geometries: list[Geometry], images: list[tuple[str, bytes]] | None = None, unlit: bool = True) -> bytes | None:
    """A binary glTF; None if nothing can be written. Geometries without vertices and unknown primitives are left out; the vertices
    are shared by a geometry's indexed primitives, and a run of them has its own slice."""
    out, primitives = _Writer(), []
    images = images or []
    for g in geometries:
        shared = None
        for p in g.primitives if len(g.positions) else ():
            if (found := triangles(p)) is None:
                continue
            mode, at = found
            if at is None and not p.count or at is not None and not len(at):
                continue
            if at is None:
                own = out.attributes(g, slice(p.first, p.first + p.count))
            else:
                own = shared = shared or out.attributes(g, slice(None))
            textured = 0 <= g.image < len(images)
            primitives.append({"attributes": own} | ({} if at is None else {"indices": out.index(at)}) | {"material": 1 + g.image if textured else 0, "mode": MODES[mode]})
    if not primitives:
        return None
    extension = {"extensions": {"KHR_materials_unlit": {}}} if unlit else {}
    rough = {"metallicFactor": 0.0, "roughnessFactor": 1.0}
    materials = [{"pbrMetallicRoughness": {"baseColorFactor": list(GREY)} | rough} | extension]
    materials += [{"pbrMetallicRoughness": {"baseColorTexture": {"index": i}} | rough} | extension for i in range(len(images))]
    pictures = [{"mimeType": mime, "bufferView": out.view(data, None)} for mime, data in images]
    out.body += b"\0" * (-len(out.body) % 8)
    document = {
        "asset": {"version": "2.0", "generator": "stratile"},
        "scene": 0,
        "scenes": [{"nodes": [0]}],
        "nodes": [{"mesh": 0}],
        "meshes": [{"primitives": primitives}],
        "materials": materials,
        "buffers": [{"byteLength": len(out.body)}],
        "bufferViews": out.views,
        "accessors": out.accessors,
    }
    if images:
        document |= {"images": pictures, "samplers": [{"magFilter": 9729, "minFilter": 9987, "wrapS": 10497, "wrapT": 10497}], "textures": [{"source": i, "sampler": 0} for i in range(len(images))]}
    if unlit:
        document["extensionsUsed"] = ["KHR_materials_unlit"]
    head = json.dumps(document, separators=(",", ":")).encode()
    head += b" " * (-len(head) % 4)
    chunks = struct.pack("<I4s", len(head), b"JSON") + head + struct.pack("<I4s", len(out.body), b"BIN\0") + bytes(out.body)
    return struct.pack("<4sII", b"glTF", 2, 12 + len(chunks)) + chunks

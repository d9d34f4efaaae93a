"""Box columns: union, padding, centre and half axes, geometric error, and the numbers documents hold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import BOX

AXES = ("x", "y", "z")


def is_empty() -> Column:
    return F.col("min_x").isNull()


def aggregates(prefix: str = "") -> list[Column]:
    """Map-side combinable union of boxes: min of minima, max of maxima; empty boxes don't count."""
    return [(F.min if c.startswith("min") else F.max)(c).alias(prefix + c) for c in BOX]


def point_aggregates(x: str, y: str, z: str) -> list[Column]:
    return [f(F.col(c).cast("double")).alias(f"{n}_{a}") for n, f in (("min", F.min), ("max", F.max)) for c, a in zip((x, y, z), AXES, strict=True)]


def union(a: str, b: str) -> dict[str, Column]:
    """Union of the boxes in columns a_min_x ... and b_min_x ...; an empty side gives the other."""
    out = {}
    for c in BOX:
        pick = F.least if c.startswith("min") else F.greatest
        out[c] = pick(F.col(f"{a}_{c}"), F.col(f"{b}_{c}"))
    return out


def extents() -> list[Column]:
    return [F.col(f"max_{a}") - F.col(f"min_{a}") for a in AXES]


def error_of_box() -> Column:
    """Half the longest side; 0 for an empty box."""
    return F.coalesce(F.greatest(*extents()) / 2.0, F.lit(0.0))


def padded(ratio: float) -> dict[str, Column]:
    """Each side moved out by ratio / 2 of the extent."""
    out = {}
    for a, e in zip(AXES, extents(), strict=True):
        out[f"min_{a}"] = F.col(f"min_{a}") - e * (ratio / 2)
        out[f"max_{a}"] = F.col(f"max_{a}") + e * (ratio / 2)
    return out


def center_axes(floor: float = 0.0) -> Column:
    """Twelve numbers: centre, then the three half axes; extents are at least floor."""
    c = [(F.col(f"max_{a}") + F.col(f"min_{a}")) / 2.0 for a in AXES]
    h = [F.greatest(e, F.lit(float(floor))) / 2.0 if floor else F.abs(e) / 2.0 for e in extents()]
    o = F.lit(0.0)
    return F.array(*c, h[0], o, o, o, h[1], o, o, o, h[2])


"""Geodesy as expressions: WGS84 frames, local planes, transverse Mercator, affine fits, level ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

A = 6378137.0
FLATTENING = 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)


def ecef(lon: Column, lat: Column, h: Column) -> tuple[Column, Column, Column]:
    """Geodetic degrees and metres to earth-centred metres."""
    lam, phi = F.radians(lon), F.radians(lat)
    n = F.lit(A) / F.sqrt(1.0 - F.lit(E2) * F.sin(phi) * F.sin(phi))
    return (n + h) * F.cos(phi) * F.cos(lam), (n + h) * F.cos(phi) * F.sin(lam), (n * (1.0 - E2) + h) * F.sin(phi)


def enu_axes(lon: Column, lat: Column) -> list[list[Column]]:
    """East, north and up unit vectors."""
    lam, phi = F.radians(lon), F.radians(lat)
    sl, cl, sp, cp = F.sin(lam), F.cos(lam), F.sin(phi), F.cos(phi)
    return [[-sl, cl, F.lit(0.0)], [-sp * cl, -sp * sl, cp], [cp * cl, cp * sl, sp]]


def enu_to_ecef(lon: Column, lat: Column, h: Column) -> Column:
    """The frame's 4 x 4 matrix, column by column: east, north, up, origin."""
    zero, one = F.lit(0.0), F.lit(1.0)
    flat = [x for axis in enu_axes(lon, lat) for x in (*axis, zero)]
    return F.array(*flat, *ecef(lon, lat, h), one)


def root_transform(lon: Column, lat: Column, h: Column, offset: tuple[Column, Column, Column]) -> Column:
    """The frame's matrix with its origin moved by an offset that is given in the frame."""
    axes, origin = enu_axes(lon, lat), ecef(lon, lat, h)
    moved = [origin[i] + sum((axes[k][i] * offset[k] for k in range(3)), F.lit(0.0)) for i in range(3)]
    flat = [x for axis in axes for x in (*axis, F.lit(0.0))]
    return F.array(*flat, *moved, F.lit(1.0))


def ecef_to_enu(p: tuple[Column, Column, Column], lon0: Column, lat0: Column, h0: Column) -> tuple[Column, ...]:
    """Earth-centred metres in the local plane at an origin: rotation transposed, no matrix inverse."""
    d = [a - b for a, b in zip(p, ecef(lon0, lat0, h0), strict=True)]
    return tuple(axis[0] * d[0] + axis[1] * d[1] + axis[2] * d[2] for axis in enu_axes(lon0, lat0))


def enu_point(p: tuple[Column, Column, Column], lon0: Column, lat0: Column, h0: Column) -> tuple[Column, ...]:
    """Local metres to earth-centred metres."""
    axes, origin = enu_axes(lon0, lat0), ecef(lon0, lat0, h0)
    return tuple(origin[i] + axes[0][i] * p[0] + axes[1][i] * p[1] + axes[2][i] * p[2] for i in range(3))


def z_to_y(p: tuple[Column, Column, Column]) -> tuple[Column, ...]:
    return p[0], -p[2], p[1]


def y_to_z(p: tuple[Column, Column, Column]) -> tuple[Column, ...]:
    return p[0], p[2], -p[1]


def level_ratio(level: Column, base: float = 0.5) -> Column:
    """Share of detail that a merged level keeps: a quarter per level, one percent at least."""
    return F.greatest(F.lit(0.01), F.lit(float(base)) * F.pow(F.lit(0.25), level + 1))


def orthometric_to_ellipsoidal(h: Column, n: Column) -> Column:
    """Height plus geoid undulation; unchanged where none is known."""
    return h + F.coalesce(n, F.lit(0.0))


def ellipsoidal_to_orthometric(h: Column, n: Column) -> Column:
    return h - F.coalesce(n, F.lit(0.0))


def geoid_applies(crs_type: Column, datum: Column, enabled: Column) -> Column:
    return enabled & crs_type.isin("EPSG", "WKT") & datum.isin("ORTHOMETRIC", "UNKNOWN")


def inverse_transverse_mercator(x: Column, y: Column, lon0: Column, k0: Column, false_easting: Column, false_northing: Column) -> tuple[Column, Column]:
    """Projected metres to longitude and latitude in degrees on WGS84 (Krueger series to third order in n)."""
    n = FLATTENING / (2 - FLATTENING)
    radius = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    xi, eta = (y - false_northing) / (k0 * radius), (x - false_easting) / (k0 * radius)
    xi1, eta1 = xi, eta
    for j, b in enumerate(beta, 1):
        xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    phi = chi
    for j, d in enumerate(delta, 1):
        phi = phi + d * F.sin(2 * j * chi)
    lam = F.atan2(F.sinh(eta1), F.cos(xi1))
    return F.degrees(lam) + lon0, F.degrees(phi)


def utm(x: Column, y: Column, code: int) -> tuple[Column, Column]:
    """EPSG 32601-32660 and 32701-32760; other codes are not supported."""
    if not (32601 <= code <= 32660 or 32701 <= code <= 32760):
        raise ValueError(f"EPSG:{code} is not a WGS84 UTM zone; no projection for it is built in")
    return projected(x, y, F.lit(code))


def projection(code: Column) -> tuple[Column, Column, Column, Column]:
    """Central meridian, scale, false easting and northing of an EPSG code; nulls where no projection for it is built in.

    WGS84 UTM zones (32601-32660, 32701-32760) and the CGCS2000 Gauss-Krueger zones of 3 degrees (4513-4533 with the zone in
    the easting, 4534-4554 without) and 6 degrees (4491-4501, 4502-4512). The CGCS2000 ellipsoid differs from WGS84's
    by a tenth of a millimetre.
    """
    among = lambda low, high: code.between(low, high)
    utm_zone = among(32601, 32660) | among(32701, 32760)
    lon0 = F.when(utm_zone, code % 100 * 6 - 183).when(among(4513, 4533), (code - 4488) * 3).when(among(4534, 4554), (code - 4509) * 3)
    lon0 = lon0.when(among(4491, 4501), (code - 4478) * 6 - 3).when(among(4502, 4512), (code - 4502) * 6 + 75)
    prefix = F.when(among(4513, 4533), code - 4488).when(among(4491, 4501), code - 4478).otherwise(0)
    scale = F.when(utm_zone, 0.9996).otherwise(1.0)
    return lon0.cast("double"), scale, (prefix * 1000000 + 500000).cast("double"), F.when(among(32701, 32760), 10000000.0).otherwise(0.0)


def projected(x: Column, y: Column, code: Column) -> tuple[Column, Column]:
    """Projected metres of an EPSG code to longitude and latitude in degrees; nulls for codes that aren't built in."""
    return inverse_transverse_mercator(x, y, *projection(code))


def needs_projection(kind: Column) -> Column:
    return kind.isin("EPSG", "WKT")


def has_reference(kind: Column) -> Column:
    """Whether the system itself says where on the earth it lies."""
    return kind == "ENU"


def corrected(kind: Column) -> Column:
    """Whether vertices are moved: a local plane's are right as they are."""
    return needs_projection(kind)


def vertical_datum(kind: Column, stated: Column) -> Column:
    """Heights of local systems are ellipsoidal; others are as stated, or unknown."""
    return F.when(needs_projection(kind), F.coalesce(stated, F.lit("UNKNOWN"))).otherwise("ELLIPSOIDAL")


def up_axis(kind: Column) -> Column:
    return F.when(kind.isNotNull(), "Y_UP")


def geodetic(kind: Column, code: Column, origin: tuple[Column, ...], p: tuple[Column, ...], frame: tuple[Column, ...]) -> tuple[Column, ...]:
    """A point of a source system in degrees and metres, without a geoid. frame: longitude, latitude and height of the local
    origin; origin: the source's offset. Points of a local plane, and of systems without a projection, are at the frame's origin, moved in height alone."""
    moved = [a + b for a, b in zip(p, origin, strict=True)]
    lon, lat = projected(moved[0], moved[1], code)
    flat = ~needs_projection(kind)
    height = F.when(kind == "ENU", moved[2]).otherwise(p[2])
    return F.when(flat, frame[0]).otherwise(lon), F.when(flat, frame[1]).otherwise(lat), F.when(flat, frame[2] + height).otherwise(moved[2])


def earth_centred(kind: Column, code: Column, origin: tuple[Column, ...], p: tuple[Column, ...], frame: tuple[Column, ...]) -> tuple[Column, ...]:
    """A point of a source system in earth-centred metres."""
    local = enu_point(tuple(a + b for a, b in zip(p, origin, strict=True)), *frame)
    other = ecef(*geodetic(kind, code, origin, p, frame))
    return tuple(F.when(kind == "ENU", a).otherwise(b) for a, b in zip(local, other, strict=True))


def local_plane(kind: Column, code: Column, origin: tuple[Column, ...], p: tuple[Column, ...], frame: tuple[Column, ...], undulation: Column) -> tuple[Column, ...]:
    """A point of a source system in the plane at frame: projected, its height corrected by the undulation (null or zero: none), then earth-centred and turned.

    A local plane's points only move by their offset; there and back through the earth's centre is the identity.
    """
    lon, lat, h = geodetic(kind, code, origin, p, frame)
    turned = ecef_to_enu(ecef(lon, lat, orthometric_to_ellipsoidal(h, undulation)), *frame)
    return tuple(F.when(kind == "ENU", a + b).when(needs_projection(kind), t).otherwise(a) for a, b, t in zip(p, origin, turned, strict=True))


def frame_origin(kind: Column, code: Column, origin: tuple[Column, ...], stated: tuple[Column, ...], undulation: Column, enabled: Column) -> tuple[Column, ...]:
    """Longitude, latitude and height of the local origin: as stated, or the projected source origin where the stated one is (0, 0). A geoid corrects heights of projected systems."""
    lon, lat = projected(origin[0], origin[1], code)
    derive = needs_projection(kind) & (stated[0] == 0) & (stated[1] == 0)
    height = F.when(derive, origin[2]).otherwise(stated[2])
    lifted = F.when(needs_projection(kind) & enabled, orthometric_to_ellipsoidal(height, undulation)).otherwise(height)
    return F.when(derive, lon).otherwise(stated[0]), F.when(derive, lat).otherwise(stated[1]), lifted


def affine_fit(image) -> list[list[Column]]:
    """Least-squares affine map from a box (columns min_x ... max_z) to the images of its corners.

    image: function of three columns that gives three columns. Returns, per output axis, the slopes over x, y, z and
    the intercept. The corners are a full two-level design, so a slope is the difference of two face means; an axis
    without extent has slope 0. The map is evaluated eight times a box instead of once a vertex.
    """
    names = ("x", "y", "z")
    corners = [(i, [F.col(f"{'max' if i >> k & 1 else 'min'}_{a}") for k, a in enumerate(names)]) for i in range(8)]
    images = [(i, image(*p)) for i, p in corners]
    extent = [F.col(f"max_{a}") - F.col(f"min_{a}") for a in names]
    center = [(F.col(f"max_{a}") + F.col(f"min_{a}")) / 2.0 for a in names]
    add = lambda cols: sum(cols[1:], cols[0])
    fit = []
    for o in range(3):
        slopes = []
        for k in range(3):
            high, low = add([v[o] for i, v in images if i >> k & 1]), add([v[o] for i, v in images if not i >> k & 1])
            slopes.append(F.when(extent[k] > 0, (high - low) / 4.0 / extent[k]).otherwise(0.0))
        mean = add([v[o] for _, v in images]) / 8.0
        fit.append([*slopes, mean - slopes[0] * center[0] - slopes[1] * center[1] - slopes[2] * center[2]])
    return fit


def affine_apply(fit: list[list[Column]], x: Column, y: Column, z: Column) -> tuple[Column, ...]:
    return tuple(f[0] * x + f[1] * y + f[2] * z + f[3] for f in fit)


#: Radians that a metre of latitude and of longitude at the equator spans (fixed values).
LATITUDE_RADIANS, LONGITUDE_RADIANS = 0.000000157891, 0.000000156785


def latitude_meters(angle: Column) -> Column:
    """Metres of a difference in latitude (radians)."""
    return angle / LATITUDE_RADIANS


def longitude_meters(angle: Column, lat: Column) -> Column:
    return angle / LONGITUDE_RADIANS * F.cos(lat)


def meters_latitude(meters: Column) -> Column:
    """Radians of latitude that metres span."""
    return meters * LATITUDE_RADIANS


def meters_longitude(meters: Column, lat: Column) -> Column:
    return meters * LONGITUDE_RADIANS / F.cos(lat)


def transform_height(origin: Column, plane: Column, offset: Column, min_z: Column) -> Column:
    """Height of a root: its origin's, else its plane's, else what lifts the box to the offset."""
    return F.coalesce(origin, plane, offset - min_z)


def center_override(stated: Column, given: Column) -> Column:
    """An option that isn't zero counts before the configuration's value."""
    return F.coalesce(F.nullif(given, F.lit(0.0)), stated)

"""Queries of the geodesy operators: a geodetic position per customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import boxes, geo
from ..sources import geoid
from .trees import _LEAF, leaf_boxes, table

D = 4


def _positions(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", (k * 37 % 360 - 180).cast("double").alias("lon"), (k * 17 % 170 - 85).cast("double").alias("lat"), F.col("c_acctbal").alias("h"))


def _r(columns: dict, digits: int = D):
    """Rounded columns; a negative zero becomes zero."""
    return [F.when(F.round(c, digits) == 0, 0.0).otherwise(F.round(c, digits)).alias(n) for n, c in columns.items()]


def cartographic_to_ecef(spark, sf_dir):
    x, y, z = geo.ecef(F.col("lon"), F.col("lat"), F.col("h"))
    return _positions(spark, sf_dir).select("c_custkey", *_r({"x": x, "y": y, "z": z}))


def enu_to_ecef(spark, sf_dir):
    m = geo.enu_to_ecef(F.col("lon"), F.col("lat"), F.col("h"))
    return _positions(spark, sf_dir).select("c_custkey", *_r({f"m{i}": m[i] for i in (0, 1, 4, 5, 6, 8, 9, 10, 12, 13, 14)}))


def local_enu(spark, sf_dir):
    """Each position in the local plane of a fixed origin."""
    e, n, u = geo.ecef_to_enu(geo.ecef(F.col("lon"), F.col("lat"), F.col("h")), F.lit(120.0), F.lit(30.0), F.lit(0.0))
    return _positions(spark, sf_dir).select("c_custkey", *_r({"e": e, "n": n, "u": u}))


def enu_round_trip(spark, sf_dir):
    """Local points to earth-centred metres and back: the point itself."""
    p = (F.col("lon") * 10, F.col("lat") * 5, F.col("h") / 100)
    q = geo.ecef_to_enu(geo.enu_point(p, F.lit(120.0), F.lit(30.0), F.lit(5.0)), F.lit(120.0), F.lit(30.0), F.lit(5.0))
    return _positions(spark, sf_dir).select("c_custkey", *_r(dict(zip("enu", q, strict=True))))


def axis_swap(spark, sf_dir):
    a, b = geo.z_to_y((F.col("lon"), F.col("lat"), F.col("h"))), geo.y_to_z((F.col("lon"), F.col("lat"), F.col("h")))
    return _positions(spark, sf_dir).select("c_custkey", *(c.alias(f"zy_{n}") for c, n in zip(a, "xyz", strict=True)), *(c.alias(f"yz_{n}") for c, n in zip(b, "xyz", strict=True)))


def root_transform(spark, sf_dir):
    m = geo.root_transform(F.col("lon"), F.col("lat"), F.col("h"), (F.lit(10.0), F.lit(-20.0), F.lit(5.0)))
    return _positions(spark, sf_dir).select("c_custkey", *_r({f"m{i}": m[i] for i in (0, 5, 10, 12, 13, 14)}))


def _bend(x, y, z):
    return x * 1.5 + y * y * 0.00123456789 + 3.0, y - x * z * 0.512345679, z * z + x * 0.25 - y * 0.123456789


def affine_fit(spark, sf_dir):
    """The best affine map of each order's box under a bent map, and its image of the box's centre."""
    df = leaf_boxes(spark, sf_dir)
    fit = geo.affine_fit(_bend)
    center = [(F.col(f"max_{a}") + F.col(f"min_{a}")) / 2.0 for a in "xyz"]
    image = geo.affine_apply(fit, *center)
    names = {f"a{i}{j}": fit[i][j] for i in range(3) for j in range(4)} | dict(zip(("ix", "iy", "iz"), image, strict=True))
    return df.select("l_orderkey", *_r(names))


def geoid_shift(spark, sf_dir):
    """Heights moved by the undulation of the position's 10-degree cell, where the reference system asks for it."""
    p = _positions(spark, sf_dir).withColumns({"gx": F.floor((F.col("lon") + 180) / 10), "gy": F.floor((F.col("lat") + 90) / 10), "kind": F.when(F.col("c_custkey") % 3 == 0, "ENU").otherwise("EPSG")})
    s = table(spark, sf_dir, "nation")
    grid = s.select((F.col("n_nationkey") % 36).cast("long").alias("gx"), F.explode(F.expr("sequence(0L, 17L)")).alias("gy"), (F.col("n_nationkey") * 1.5 - 20).alias("n"))
    joined = p.join(F.broadcast(grid), ["gx", "gy"], "left")  # a grid of fixed size
    applies = geo.geoid_applies(F.col("kind"), F.lit("ORTHOMETRIC"), F.lit(True))
    return joined.select("c_custkey", F.when(applies, geo.orthometric_to_ellipsoidal(F.col("h"), F.col("n"))).otherwise(F.col("h")).alias("h"), geo.ellipsoidal_to_orthometric(F.col("h"), F.col("n")).alias("back"))


def transverse_mercator(spark, sf_dir):
    """Points of UTM zone 50 to degrees."""
    k = F.col("c_custkey")
    lon, lat = geo.utm(500000.0 + (k % 700 - 350) * 800.0, (k % 9000) * 1000.0, 32650)
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


def transform_height(spark, sf_dir):
    """Height of the root: the origin's, else the plane's, else what lifts the box to the offset."""
    k = F.col("l_orderkey")
    origin, plane = F.when(k % 3 == 0, k.cast("double")), F.when(k % 3 == 1, (k * 2).cast("double"))
    return leaf_boxes(spark, sf_dir).select("l_orderkey", geo.transform_height(origin, plane, F.lit(50.0), F.col("min_z")).alias("height"))


CODES = (32650, 32750, 4547, 4499)


def _sources(spark, sf_dir):
    """A source system and a point in it per customer."""
    k = F.col("c_custkey")
    code = F.element_at(F.array(*map(F.lit, CODES)), (k % 4 + 1).cast("int"))
    kind = F.when(k % 5 == 0, "ENU").when(k % 5 == 4, "LOCAL").otherwise("EPSG")
    return table(spark, sf_dir, "customer").select("c_custkey", kind.alias("kind"), code.alias("code"), F.when(k % 4 == 3, 21500000.0).otherwise(500000.0).alias("ox"), ((k % 40) * 100000.0).alias("oy"), F.lit(7.0).alias("oz"), (k % 700 - 350).cast("double").alias("x"), (k % 900 - 450).cast("double").alias("y"), (F.col("c_acctbal") / 100).alias("z"), (k % 100 - 50).cast("double").alias("u"))


def _chain(point):
    """A step of the chain over the source columns, in a frame at 117, 30, 20."""
    origin, p = (tuple(map(F.col, names)) for names in (("ox", "oy", "oz"), ("x", "y", "z")))
    return point(F.col("kind"), F.col("code"), origin, p, (F.lit(117.0), F.lit(30.0), F.lit(20.0)))


def projected_points(spark, sf_dir):
    """Points of four reference systems to degrees, the code being a column."""
    lon, lat = geo.projected(F.col("ox") + F.col("x"), F.col("oy") + F.col("y"), F.col("code"))
    return _sources(spark, sf_dir).select("c_custkey", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


def source_to_geodetic(spark, sf_dir):
    return _sources(spark, sf_dir).select("c_custkey", *_r(dict(zip(("lon", "lat", "h"), _chain(geo.geodetic), strict=True)), 6))


def source_to_ecef(spark, sf_dir):
    return _sources(spark, sf_dir).select("c_custkey", *_r(dict(zip("xyz", _chain(geo.earth_centred), strict=True)), 3))


def source_to_local(spark, sf_dir):
    """The chain that corrects vertices: projection, geoid, earth-centred, local plane."""
    point = _chain(lambda *a: geo.local_plane(*a, F.col("u")))
    return _sources(spark, sf_dir).select("c_custkey", *_r(dict(zip("enu", point, strict=True)), 2))


def frame_origin(spark, sf_dir):
    """Local origins: stated ones, or projected from the source's origin; every other customer with a geoid."""
    k = F.col("c_custkey")
    stated = (F.when(k % 2 == 0, 0.0).otherwise(110.0), F.when(k % 2 == 0, 0.0).otherwise(25.0), F.col("z"))
    found = geo.frame_origin(F.col("kind"), F.col("code"), tuple(map(F.col, ("ox", "oy", "oz"))), stated, F.col("u"), k % 3 == 0)
    return _sources(spark, sf_dir).select("c_custkey", *_r(dict(zip(("lon", "lat", "h"), found, strict=True)), 6))


def crs_facts(spark, sf_dir):
    kind = F.col("kind")
    stated = F.when(F.col("c_custkey") % 3 == 0, "ORTHOMETRIC")
    return _sources(spark, sf_dir).select("c_custkey", geo.needs_projection(kind).alias("projects"), geo.has_reference(kind).alias("built_in"), geo.corrected(kind).alias("corrected"), geo.vertical_datum(kind, stated).alias("datum"), geo.up_axis(kind).alias("up"))


def degree_lengths(spark, sf_dir):
    lat = F.radians("lat")
    return _positions(spark, sf_dir).select("c_custkey", *_r({"m_lat": geo.latitude_meters(lat), "m_lon": geo.longitude_meters(F.radians("lon"), lat)}), *_r({"lat": geo.meters_latitude(F.col("h")), "lon": geo.meters_longitude(F.col("h"), lat)}, 9))


def _undulations(spark, sf_dir, cubic):
    k = F.col("s_suppkey")
    grid = spark.range(36 * 19).select((F.col("id") % 36).alias("gx"), F.floor(F.col("id") / 36).alias("gy"), ((F.col("id") * 37) % 101 - 50).cast("double").alias("n"))  # a grid of fixed size
    points = table(spark, sf_dir, "supplier").select(k.alias("id"), ((k * 37 % 3600) / 10 - 180).alias("lon"), ((k * 17 % 1800) / 10 - 90).alias("lat"))
    return geoid.undulations(points, grid, 36, cubic).select("id", *_r({"n": F.col("n")}, 6))


def geoid_bilinear(spark, sf_dir):
    """Undulations at suppliers' positions on a grid of 10 degrees."""
    return _undulations(spark, sf_dir, False)


def geoid_cubic(spark, sf_dir):
    return _undulations(spark, sf_dir, True)


def box_error(spark, sf_dir):
    return leaf_boxes(spark, sf_dir).select("l_orderkey", boxes.error_of_box().alias("ge"))


def corrected_vertices(spark, sf_dir):
    """Vertices under the affine map of their order: eight evaluations an order instead of one a vertex."""
    fit = geo.affine_fit(_bend)
    maps = leaf_boxes(spark, sf_dir).select(F.col("l_orderkey").alias("k"), *(fit[i][j].alias(f"a{i}{j}") for i in range(3) for j in range(4)))
    v = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"), F.col("l_discount").alias("z"))
    out = [F.col(f"a{i}0") * F.col("x") + F.col(f"a{i}1") * F.col("y") + F.col(f"a{i}2") * F.col("z") + F.col(f"a{i}3") for i in range(3)]
    return v.join(maps, F.col("l_orderkey") == F.col("k")).groupBy("l_orderkey").agg(*(F.round(f(c), 3).alias(f"{n}_{a}") for c, a in zip(out, "xyz", strict=True) for f, n in ((F.min, "min"), (F.max, "max"))))


def _rq(expression: str, name: str, digits: int = D) -> str:
    return f"case when round({expression}, {digits}) = 0 then 0 else round({expression}, {digits}) end {name}"


_P = "with p as (select c_custkey, (c_custkey * 37 % 360 - 180)::double lon, (c_custkey * 17 % 170 - 85)::double lat, c_acctbal h from customer)"
_A, _F = "6378137.0::double", "(1.0::double / 298.257223563::double)"
_E2 = f"({_F} * (2 - {_F}))"
_T = f"{_P}, t as (select *, radians(lon) l, radians(lat) f, {_A} / sqrt(1.0::double - {_E2} * sin(radians(lat)) * sin(radians(lat))) nn from p), e as (select *, (nn + h) * cos(f) * cos(l) x, (nn + h) * cos(f) * sin(l) y, (nn * (1.0::double - {_E2}) + h) * sin(f) z from t)"


def _local(lon: float, lat: float, h: float) -> str:
    return f"(select radians({lon}::double) l0, radians({lat}::double) f0, {_A} / sqrt(1.0::double - {_E2} * sin(radians({lat}::double)) * sin(radians({lat}::double))) n0, {h}::double h0)"


_O = f"{_T}, o as (select *, (n0 + h0) * cos(f0) * cos(l0) x0, (n0 + h0) * cos(f0) * sin(l0) y0, (n0 * (1.0::double - {_E2}) + h0) * sin(f0) z0 from {_local(120.0, 30.0, 0.0)})"


def _corner_sql() -> str:
    pts = [[f"{'max' if i >> k & 1 else 'min'}_{a}" for k, a in enumerate("xyz")] for i in range(8)]
    img = [(f"({x} * 1.5::double + {y} * {y} * 0.00123456789::double + 3.0::double)", f"({y} - {x} * {z} * 0.512345679::double)", f"({z} * {z} + {x} * 0.25::double - {y} * 0.123456789::double)") for x, y, z in pts]
    cols = []
    for o in range(3):
        for k, a in enumerate("xyz"):
            hi, lo = " + ".join(v[o] for i, v in enumerate(img) if i >> k & 1), " + ".join(v[o] for i, v in enumerate(img) if not i >> k & 1)
            cols.append(f"case when max_{a} - min_{a} > 0 then (({hi}) - ({lo})) / 4 / (max_{a} - min_{a}) else 0 end a{o}{k}")
        cols.append(f"({' + '.join(v[o] for v in img)}) / 8 m{o}")
    return ", ".join(cols)


_FIT = f"{_LEAF}, f as (select *, {_corner_sql()}, (max_x + min_x) / 2 cx, (max_y + min_y) / 2 cy, (max_z + min_z) / 2 cz from b), g as (select *, {', '.join(f'm{o} - a{o}0 * cx - a{o}1 * cy - a{o}2 * cz a{o}3' for o in range(3))} from f)"


def _tm_sql() -> str:
    n = geo.FLATTENING / (2 - geo.FLATTENING)
    r = geo.A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    b = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    d = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    lit = lambda v: f"{v!r}::double"
    sinh, cosh = (lambda v: f"((exp({v}) - exp(-({v}))) / 2)"), (lambda v: f"((exp({v}) + exp(-({v}))) / 2)")
    xi1 = "xi" + "".join(f" - {lit(v)} * sin({2 * j} * xi) * {cosh(f'{2 * j} * eta')}" for j, v in enumerate(b, 1))
    eta1 = "eta" + "".join(f" - {lit(v)} * cos({2 * j} * xi) * {sinh(f'{2 * j} * eta')}" for j, v in enumerate(b, 1))
    phi = "chi" + "".join(f" + {lit(v)} * sin({2 * j} * chi)" for j, v in enumerate(d, 1))
    return f"""with q as (select c_custkey, (c_custkey % 9000) * 1000.0::double / (0.9996::double * {lit(r)}) xi, ((c_custkey % 700 - 350) * 800.0::double) / (0.9996::double * {lit(r)}) eta from customer),
      s as (select c_custkey, {xi1} xi1, {eta1} eta1 from q), c as (select *, asin(sin(xi1) / {cosh('eta1')}) chi from s)
      select c_custkey, round(degrees(atan2({sinh('eta1')}, cos(xi1))) + 117.0::double, 6) lon, round(degrees({phi}), 6) lat from c"""


def _sources_sql() -> str:
    """The sources with projected degrees, level by level as the expressions go."""
    n = (1 / 298.257223563) / (2 - 1 / 298.257223563)
    r = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    b = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    d = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    lit = lambda v: f"{v!r}::double"
    sinh, cosh = (lambda v: f"((exp({v}) - exp(-({v}))) / 2)"), (lambda v: f"((exp({v}) + exp(-({v}))) / 2)")
    xi1 = "xi" + "".join(f" - {lit(v)} * sin({2 * j} * xi) * {cosh(f'{2 * j} * eta')}" for j, v in enumerate(b, 1))
    eta1 = "eta" + "".join(f" - {lit(v)} * cos({2 * j} * xi) * {sinh(f'{2 * j} * eta')}" for j, v in enumerate(b, 1))
    phi = "chi" + "".join(f" + {lit(v)} * sin({2 * j} * chi)" for j, v in enumerate(d, 1))
    at = lambda x, y, tag: f"""q{tag} as (select *, ({y} - fn) / (k0 * {lit(r)}) xi, ({x} - fe) / (k0 * {lit(r)}) eta from sys), s{tag} as (select *, {xi1} xi1, {eta1} eta1 from q{tag}), c{tag} as (select *, asin(sin(xi1) / {cosh('eta1')}) chi from s{tag}),
      g{tag} as (select *, degrees(atan2({sinh('eta1')}, cos(xi1))) + lon0 plon, degrees({phi}) plat from c{tag})"""  # noqa: E731
    return f"""with src as (
      select c_custkey, case when c_custkey % 5 = 0 then 'ENU' when c_custkey % 5 = 4 then 'LOCAL' else 'EPSG' end kind, c_custkey % 4 m, case when c_custkey % 4 = 3 then 21500000.0::double else 500000.0::double end ox, (c_custkey % 40) * 100000.0::double oy, 7.0::double oz,
        (c_custkey % 700 - 350)::double x, (c_custkey % 900 - 450)::double y, c_acctbal / 100 z, (c_custkey % 100 - 50)::double u from customer),
      sys as (select *, case m when 2 then 114.0::double when 3 then 123.0::double else 117.0::double end lon0, case when m < 2 then 0.9996::double else 1.0::double end k0, case when m = 3 then 21500000.0::double else 500000.0::double end fe, case when m = 1 then 10000000.0::double else 0.0::double end fn from src),
      {at('(ox + x)', '(oy + y)', '')}, {at('ox', 'oy', '_o')},
      geod as (select *, case when kind = 'EPSG' then plon else 117.0::double end lon, case when kind = 'EPSG' then plat else 30.0::double end lat, case kind when 'EPSG' then z + oz when 'ENU' then 20.0::double + z + oz else 20.0::double + z end h from g)"""


_FRAME = f"f0 as (select *, (n0 + h0) * cos(f0) * cos(l0) x0, (n0 + h0) * cos(f0) * sin(l0) y0, (n0 * (1.0::double - {_E2}) + h0) * sin(f0) z0 from {_local(117.0, 30.0, 20.0)})"


def _ecef_sql(height: str, tag: str) -> str:
    return f"t{tag} as (select *, radians(lon) l, radians(lat) f, {_A} / sqrt(1.0::double - {_E2} * sin(radians(lat)) * sin(radians(lat))) nn, {height} hh from geod), e{tag} as (select *, (nn + hh) * cos(f) * cos(l) ex, (nn + hh) * cos(f) * sin(l) ey, (nn * (1.0::double - {_E2}) + hh) * sin(f) ez from t{tag})"


def _geoid_sql(cubic: bool) -> str:
    near, far = "((1.5::double * {t} - 2.5::double) * {t} * {t} + 1)", "(((-0.5::double * {t} + 2.5::double) * {t} - 4) * {t} + 2)"
    w = [(-1, far, "(1 + {t})"), (0, near, "{t}"), (1, near, "(1 - {t})"), (2, far, "(2 - {t})")] if cubic else [(0, "(1 - {t})", "{t}"), (1, "{t}", "{t}")]
    cells = " union all ".join(f"select id, ((x + {i}) % 36 + 36) % 36 gx, least(greatest(y + {j}, 0), 18) gy, {a.format(t=s.format(t='tx'))} * {b.format(t=r.format(t='ty'))} w from p" for i, a, s in w for j, b, r in w)
    return f"""with q as (select s_suppkey id, (((s_suppkey * 37 % 3600) / 10.0::double - 180 + 360) % 360) / 10.0::double ax, (90 - ((s_suppkey * 17 % 1800) / 10.0::double - 90)) / 10.0::double ay from supplier),
      p as (select id, floor(ax)::bigint x, floor(ay)::bigint y, ax - floor(ax) tx, ay - floor(ay) ty from q), a as ({cells}),
      grid as (select i % 36 gx, i // 36 gy, ((i * 37) % 101 - 50)::double n from range({36 * 19}) t(i))
      select id, {_rq('sum(w * n)', 'n', 6)} from a join grid using (gx, gy) group by 1"""


QUERIES = {f.__name__: f for f in (cartographic_to_ecef, enu_to_ecef, local_enu, enu_round_trip, axis_swap, root_transform, affine_fit, geoid_shift, transverse_mercator, transform_height, projected_points, source_to_geodetic, source_to_ecef, source_to_local, frame_origin, crs_facts, degree_lengths, geoid_bilinear, geoid_cubic, box_error, corrected_vertices)}

_M = {0: "-sin(l)", 1: "cos(l)", 4: "-sin(f) * cos(l)", 5: "-sin(f) * sin(l)", 6: "cos(f)", 8: "cos(f) * cos(l)", 9: "cos(f) * sin(l)", 10: "sin(f)", 12: "x", 13: "y", 14: "z"}

ORACLE_SQL = {
    "cartographic_to_ecef": f"{_T} select c_custkey, {_rq('x', 'x')}, {_rq('y', 'y')}, {_rq('z', 'z')} from e",
    "enu_to_ecef": f"{_T} select c_custkey, {', '.join(_rq(s, f'm{i}') for i, s in _M.items())} from e",
    "local_enu": f"{_O} select c_custkey, {_rq('-sin(l0) * (x - x0) + cos(l0) * (y - y0)', 'e')}, {_rq('-sin(f0) * cos(l0) * (x - x0) - sin(f0) * sin(l0) * (y - y0) + cos(f0) * (z - z0)', 'n')}, {_rq('cos(f0) * cos(l0) * (x - x0) + cos(f0) * sin(l0) * (y - y0) + sin(f0) * (z - z0)', 'u')} from e, o",
    "enu_round_trip": f"{_P} select c_custkey, {_rq('lon * 10', 'e')}, {_rq('lat * 5', 'n')}, {_rq('h / 100', 'u')} from p",
    "axis_swap": f"{_P} select c_custkey, lon zy_x, -h zy_y, lat zy_z, lon yz_x, h yz_y, -lat yz_z from p",
    "root_transform": f"{_T} select c_custkey, {_rq('-sin(l)', 'm0')}, {_rq('-sin(f) * sin(l)', 'm5')}, {_rq('sin(f)', 'm10')}, {_rq('x - sin(l) * 10 - sin(f) * cos(l) * -20 + cos(f) * cos(l) * 5', 'm12')}, {_rq('y + cos(l) * 10 - sin(f) * sin(l) * -20 + cos(f) * sin(l) * 5', 'm13')}, {_rq('z + cos(f) * -20 + sin(f) * 5', 'm14')} from e",
    "affine_fit": f"{_FIT} select l_orderkey, {', '.join(_rq(f'a{i}{j}', f'a{i}{j}') for i in range(3) for j in range(4))}, {', '.join(_rq(f'a{i}0 * cx + a{i}1 * cy + a{i}2 * cz + a{i}3', n) for i, n in enumerate(('ix', 'iy', 'iz')))} from g",
    "geoid_shift": f"{_P}, g as (select n_nationkey % 36 gx, unnest(range(18)) gy, n_nationkey * 1.5::double - 20 n from nation) select c_custkey, case when c_custkey % 3 <> 0 then h + coalesce(n, 0) else h end h, h - coalesce(n, 0) back from p left join g on gx = floor((lon + 180) / 10) and gy = floor((lat + 90) / 10)",
    "transverse_mercator": _tm_sql(),
    "projected_points": f"{_sources_sql()} select c_custkey, round(plon, 6) lon, round(plat, 6) lat from g",
    "source_to_geodetic": f"{_sources_sql()} select c_custkey, {_rq('lon', 'lon', 6)}, {_rq('lat', 'lat', 6)}, {_rq('h', 'h', 6)} from geod",
    "source_to_ecef": f"""{_sources_sql()}, {_ecef_sql('h', '1')}, {_FRAME}, m as (select *, x + ox mx, y + oy my, z + oz mz from e1, f0)
      select c_custkey, {', '.join(_rq(f"case when kind = 'ENU' then {o} + {i} else {e} end", a, 3) for a, e, o, i in (('x', 'ex', 'x0', '-sin(l0) * mx + -sin(f0) * cos(l0) * my + cos(f0) * cos(l0) * mz'), ('y', 'ey', 'y0', 'cos(l0) * mx + -sin(f0) * sin(l0) * my + cos(f0) * sin(l0) * mz'), ('z', 'ez', 'z0', 'cos(f0) * my + sin(f0) * mz')))} from m""",
    "source_to_local": f"""{_sources_sql()}, {_ecef_sql('h + u', '2')}, {_FRAME}
      select c_custkey, {', '.join(_rq(f"case kind when 'ENU' then {p} + {o} when 'EPSG' then {t} else {p} end", a, 2) for a, p, o, t in (('e', 'x', 'ox', '-sin(l0) * (ex - x0) + cos(l0) * (ey - y0)'), ('n', 'y', 'oy', '-sin(f0) * cos(l0) * (ex - x0) - sin(f0) * sin(l0) * (ey - y0) + cos(f0) * (ez - z0)'), ('u', 'z', 'oz', 'cos(f0) * cos(l0) * (ex - x0) + cos(f0) * sin(l0) * (ey - y0) + sin(f0) * (ez - z0)')))} from e2, f0""",
    "frame_origin": f"""{_sources_sql()}, w as (select *, kind = 'EPSG' and c_custkey % 2 = 0 derive from g_o)
      select c_custkey, {_rq('case when derive then plon when c_custkey % 2 = 0 then 0 else 110.0::double end', 'lon', 6)}, {_rq('case when derive then plat when c_custkey % 2 = 0 then 0 else 25.0::double end', 'lat', 6)}, {_rq("case when derive then oz else z end + case when kind = 'EPSG' and c_custkey % 3 = 0 then u else 0 end", 'h', 6)} from w""",
    "crs_facts": f"{_sources_sql()} select c_custkey, kind = 'EPSG' projects, kind = 'ENU' built_in, kind = 'EPSG' corrected, case when kind <> 'EPSG' then 'ELLIPSOIDAL' when c_custkey % 3 = 0 then 'ORTHOMETRIC' else 'UNKNOWN' end datum, 'Y_UP' up from src",
    "degree_lengths": f"{_P} select c_custkey, {_rq('radians(lat) / 0.000000157891::double', 'm_lat')}, {_rq('radians(lon) / 0.000000156785::double * cos(radians(lat))', 'm_lon')}, {_rq('h * 0.000000157891::double', 'lat', 9)}, {_rq('h * 0.000000156785::double / cos(radians(lat))', 'lon', 9)} from p",
    "geoid_bilinear": _geoid_sql(False),
    "geoid_cubic": _geoid_sql(True),
    "transform_height": f"{_LEAF} select l_orderkey, case l_orderkey % 3 when 0 then l_orderkey when 1 then l_orderkey * 2 else 50.0::double - min_z end::double height from b",
    "box_error": f"{_LEAF} select l_orderkey, greatest(max_x - min_x, max_y - min_y, max_z - min_z) / 2 ge from b",
    "corrected_vertices": f"{_FIT} select i.l_orderkey, " + ", ".join(f"round({fn}(a{o}0 * l_quantity + a{o}1 * l_extendedprice + a{o}2 * l_discount + a{o}3), 3) {fn}_{a}" for o, a in enumerate("xyz") for fn in ("min", "max")) + " from lineitem i join g using (l_orderkey) group by 1",
}

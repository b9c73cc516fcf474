"""Coordinate systems: longitudes, geodesic lengths, the choice of an equidistant
system for a box, and projections by published series (Snyder, 1987)."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrascape.model import PickedCRS

# The WGS84 ellipsoid; the largest span of an azimuthal system, km; in
# ``pick_crs`` the limits of 6 and 84 degrees and the systems' names.
A, FLATTENING = 6378137.0, 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
REGION_KM = 2500
#: Mean radius of the sphere of the other projections, metres.
RADIUS = 6371008.8


def normalize_lon(lon: Column) -> Column:
    """To -180 (included) .. 180."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def centroid_lon(minx: Column, maxx: Column) -> Column:
    """Middle of two longitudes, also where the span crosses the antimeridian."""
    left, right = normalize_lon(minx), normalize_lon(maxx)
    return normalize_lon((F.when(right < left, right + 360).otherwise(right) + left) / 2)


def _wrap(lon: float) -> float:
    return (lon + 180) % 360 - 180


def geodesic_m(lon1: float, lat1: float, lon2: float, lat2: float) -> float:
    """Length of the shortest geodesic (Vincenty, 1975; near antipodes, where the
    iteration does not settle, along the meridian circle)."""
    b = A * (1 - FLATTENING)
    u1, u2 = (math.atan((1 - FLATTENING) * math.tan(math.radians(t))) for t in (lat1, lat2))
    span = math.radians(_wrap(lon2 - lon1))
    lam = span
    for _ in range(200):
        x = math.cos(u2) * math.sin(lam)
        y = math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam)
        sin_s = math.hypot(x, y)
        if sin_s == 0:
            return 0.0
        cos_s = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        s = math.atan2(sin_s, cos_s)
        sin_a = math.cos(u1) * math.cos(u2) * math.sin(lam) / sin_s
        cos2a = 1 - sin_a * sin_a
        c2m = cos_s - 2 * math.sin(u1) * math.sin(u2) / cos2a if cos2a > 1e-15 else 0.0
        c = FLATTENING / 16 * cos2a * (4 + FLATTENING * (4 - 3 * cos2a))
        new = span + (1 - c) * FLATTENING * sin_a * (s + c * sin_s * (c2m + c * cos_s * (2 * c2m * c2m - 1)))
        if abs(new - lam) < 1e-12:
            k = cos2a * (A * A - b * b) / (b * b)
            big = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
            small = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
            ds = small * sin_s * (c2m + small / 4 * (cos_s * (2 * c2m * c2m - 1) - small / 6 * c2m * (4 * sin_s * sin_s - 3) * (4 * c2m * c2m - 3)))
            return b * big * (s - ds)
        lam = new
    quarter = 10001965.729
    return 2 * quarter - abs(math.radians(lat1 + lat2)) * b


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")


def pick_crs(minx: float, miny: float, maxx: float, maxy: float) -> PickedCRS:
    """An equidistant system for a box of degrees: UTM within 6 degrees and away from
    the poles; azimuthal to REGION_KM; conic for wider than tall; else azimuthal.

    Bounds of exactly -180 and 180 normalise to the same longitude, so a global box
    counts as narrow, and spans are shortest lines; both are kept as they are.
    """
    left, right = _wrap(minx), _wrap(maxx)
    span = (right + 360 if right < left else right) - left
    lon0 = _wrap(left + span / 2)
    lat0, tall = (miny + maxy) / 2, maxy - miny
    ew, ns = geodesic_m(minx, lat0, maxx, lat0) / 1000, geodesic_m(lon0, miny, lon0, maxy) / 1000
    if span <= 6 and abs(lat0) < 84:
        zone = int((lon0 + 180) // 6) + 1
        return PickedCRS(f"EPSG:{(32600 if lat0 >= 0 else 32700) + zone}", f"UTM zone {zone}: {span:.1f} degrees, {max(ew, ns):.0f} km")
    tail = f"+lat_0={lat0:.8f} +lon_0={lon0:.8f} +x_0=0 +y_0=0 +datum=WGS84 +units=m +no_defs"
    if max(ew, ns) <= REGION_KM or ew <= ns:
        return PickedCRS(f"+proj=aeqd {tail}", f"azimuthal equidistant: {max(ew, ns):.0f} km")
    return PickedCRS(f"+proj=eqdc +lat_1={miny + tall / 4:.8f} +lat_2={miny + 3 * tall / 4:.8f} {tail}", f"equidistant conic: {ew:.0f} km wide")


def choose_crs(boxes: DataFrame, key: str) -> DataFrame:
    """``key, crs, rationale, system`` (its PARAMETERS) of each box (``minx, miny, maxx, maxy`` in degrees)."""

    def run(batches):
        for d in batches:
            picked = [pick_crs(*r) for r in d[["minx", "miny", "maxx", "maxy"]].itertuples(index=False)]
            numbers = zip(*[parameters(p.crs) for p in picked])
            named = dict(zip([f.split()[0] for f in PARAMETERS.split(", ")], numbers))
            yield d[[key]].assign(crs=[p.crs for p in picked], rationale=[p.rationale for p in picked], **named)

    kind = boxes.schema[key].dataType.simpleString()
    got = boxes.select(key, "minx", "miny", "maxx", "maxy").mapInPandas(run, f"{key} {kind}, crs string, rationale string, {PARAMETERS}")
    return got.select(key, "crs", "rationale", F.struct(*[f.split()[0] for f in PARAMETERS.split(", ")]).alias("system"))


def utm(lon: Column, lat: Column, zone: int, south: bool = False) -> tuple[Column, Column]:
    """Forward transverse Mercator of a UTM zone, metres."""
    return _mercator(lon, lat, F.lit(zone * 6.0 - 183), F.lit(1e7 if south else 0.0))


def utm_inverse(x: Column, y: Column, zone: int, south: bool = False) -> tuple[Column, Column]:
    """Longitude and latitude of a UTM coordinate."""
    return _mercator_inverse(x, y, F.lit(zone * 6.0 - 183), F.lit(1e7 if south else 0.0))


def _mercator(lon: Column, lat: Column, lon0: Column, north: Column) -> tuple[Column, Column]:
    e2p = E2 / (1 - E2)
    phi, lam = F.radians(lat), F.radians(normalize_lon(lon - lon0))
    n = A / F.sqrt(1 - E2 * F.sin(phi) ** 2)
    t, c, a = F.tan(phi) ** 2, e2p * F.cos(phi) ** 2, lam * F.cos(phi)
    x = 0.9996 * n * (a + (1 - t + c) * a**3 / 6 + (5 - 18 * t + t**2 + 72 * c - 58 * e2p) * a**5 / 120) + 500000
    y = 0.9996 * (_meridian(phi) + n * F.tan(phi) * (a**2 / 2 + (5 - t + 9 * c + 4 * c**2) * a**4 / 24 + (61 - 58 * t + t**2 + 600 * c - 330 * e2p) * a**6 / 720))
    return x, y + north


def _mercator_inverse(x: Column, y: Column, lon0: Column, north: Column) -> tuple[Column, Column]:
    e2p = E2 / (1 - E2)
    e1 = (1 - math.sqrt(1 - E2)) / (1 + math.sqrt(1 - E2))
    mu = (y - north) / 0.9996 / (A * (1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256))
    p = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + 151 * e1**3 / 96 * F.sin(6 * mu) + 1097 * e1**4 / 512 * F.sin(8 * mu)
    c, t = e2p * F.cos(p) ** 2, F.tan(p) ** 2
    n, r = A / F.sqrt(1 - E2 * F.sin(p) ** 2), A * (1 - E2) / F.pow(1 - E2 * F.sin(p) ** 2, 1.5)
    d = (x - 500000) / (n * 0.9996)
    lat = p - n * F.tan(p) / r * (d**2 / 2 - (5 + 3 * t + 10 * c - 4 * c**2 - 9 * e2p) * d**4 / 24 + (61 + 90 * t + 298 * c + 45 * t**2 - 252 * e2p - 3 * c**2) * d**6 / 720)
    lon = (d - (1 + 2 * t + c) * d**3 / 6 + (5 - 2 * c + 28 * t - 3 * c**2 + 8 * e2p + 24 * t**2) * d**5 / 120) / F.cos(p)
    return normalize_lon(F.degrees(lon) + lon0), F.degrees(lat)


def _meridian(phi: Column) -> Column:
    return A * ((1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256) * phi - (3 * E2 / 8 + 3 * E2**2 / 32 + 45 * E2**3 / 1024) * F.sin(2 * phi) + (15 * E2**2 / 256 + 45 * E2**3 / 1024) * F.sin(4 * phi) - 35 * E2**3 / 3072 * F.sin(6 * phi))


def azimuthal(lon: Column, lat: Column, lon0, lat0, radius: float = RADIUS) -> tuple[Column, Column]:
    """Azimuthal equidistant on the sphere of equal mean radius, metres."""
    p, p0, l = F.radians(lat), F.radians(_col(lat0)), F.radians(lon - lon0)  # noqa: E741
    cos_c = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.sin(p0) * F.sin(p) + F.cos(p0) * F.cos(p) * F.cos(l)))
    c = F.acos(cos_c)
    k = F.when(F.abs(c) < 1e-12, 1.0).otherwise(c / F.sin(c))
    return radius * k * F.cos(p) * F.sin(l), radius * k * (F.cos(p0) * F.sin(p) - F.sin(p0) * F.cos(p) * F.cos(l))


def azimuthal_inverse(x: Column, y: Column, lon0, lat0, radius: float = RADIUS) -> tuple[Column, Column]:
    p0 = F.radians(_col(lat0))
    rho = F.sqrt(x * x + y * y)
    c = rho / radius
    s = F.when(rho < 1e-9, 0.0).otherwise(F.sin(c) / rho)
    lat = F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.cos(c) * F.sin(p0) + y * s * F.cos(p0)))))
    lon = lon0 + F.degrees(F.atan2(x * s, F.cos(c) * F.cos(p0) - y * s * F.sin(p0)))
    return normalize_lon(lon), lat


def _cone(lat1: Column, lat2: Column) -> tuple[Column, Column, Column]:
    """The cone's constant, its offset, and whether it is a cylinder (parallels that
    mirror each other at the equator)."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    n = F.when(F.abs(p2 - p1) < 1e-9, F.sin(p1)).otherwise((F.cos(p1) - F.cos(p2)) / (p2 - p1))
    flat = F.abs(n) < 1e-9
    n = F.when(flat, 1.0).otherwise(n)
    return n, F.cos(p1) / n + p1, flat


def conic(lon: Column, lat: Column, lon0, lat0, lat1, lat2, radius: float = RADIUS) -> tuple[Column, Column]:
    """Equidistant conic on the sphere of equal mean radius, metres."""
    lat0, lat1, lat2 = (_col(v) for v in (lat0, lat1, lat2))
    n, g, flat = _cone(lat1, lat2)
    l, p, p0 = F.radians(normalize_lon(lon - lon0)), F.radians(lat), F.radians(lat0)  # noqa: E741
    rho, rho0 = radius * (g - p), radius * (g - p0)
    x = F.when(flat, radius * l * F.cos(F.radians(lat1))).otherwise(rho * F.sin(n * l))
    return x, F.when(flat, radius * (p - p0)).otherwise(rho0 - rho * F.cos(n * l))


def conic_inverse(x: Column, y: Column, lon0, lat0, lat1, lat2, radius: float = RADIUS) -> tuple[Column, Column]:
    lat0, lat1, lat2 = (_col(v) for v in (lat0, lat1, lat2))
    n, g, flat = _cone(lat1, lat2)
    p0 = F.radians(lat0)
    down = radius * (g - p0) - y
    rho = F.signum(n) * F.sqrt(x * x + down * down)
    lat = F.when(flat, p0 + y / radius).otherwise(g - rho / radius)
    lon = F.when(flat, x / (radius * F.cos(F.radians(lat1)))).otherwise(F.atan2(F.signum(n) * x, F.signum(n) * down) / n)
    return normalize_lon(lon0 + F.degrees(lon)), F.degrees(lat)


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


#: Numbers of a system that ``choose_crs`` names, so that rows of several systems are one plan.
PARAMETERS = "kind string, lon0 double, lat0 double, lat1 double, lat2 double, north double"


def parameters(crs: str) -> tuple[str, float, float, float, float, float]:
    """The numbers of a system's name, as in PARAMETERS."""
    if found := re.fullmatch(r"EPSG:32([67])(\d\d)", crs):
        return "utm", int(found[2]) * 6.0 - 183, 0.0, 0.0, 0.0, 1e7 if found[1] == "7" else 0.0
    said = dict(re.findall(r"\+(\w+)=(\S+)", crs))
    if said.get("proj") not in ("aeqd", "eqdc"):
        raise ValueError(f"no projection for {crs!r}")
    return said["proj"], float(said["lon_0"]), float(said["lat_0"]), float(said.get("lat_1", 0)), float(said.get("lat_2", 0)), 0.0


def project(p: Column, lon: Column, lat: Column) -> tuple[Column, Column]:
    """Metres in the system of a struct of PARAMETERS."""
    return _by_kind(p, _mercator(lon, lat, p["lon0"], p["north"]), azimuthal(lon, lat, p["lon0"], p["lat0"]), conic(lon, lat, p["lon0"], p["lat0"], p["lat1"], p["lat2"]))


def unproject(p: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude of metres in the system of a struct of PARAMETERS."""
    return _by_kind(p, _mercator_inverse(x, y, p["lon0"], p["north"]), azimuthal_inverse(x, y, p["lon0"], p["lat0"]), conic_inverse(x, y, p["lon0"], p["lat0"], p["lat1"], p["lat2"]))


def _by_kind(p: Column, utm: tuple, aeqd: tuple, eqdc: tuple) -> tuple[Column, Column]:
    pick = lambda k: F.when(p["kind"] == "utm", utm[k]).when(p["kind"] == "aeqd", aeqd[k]).otherwise(eqdc[k])
    return pick(0), pick(1)

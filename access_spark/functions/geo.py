"""Coordinate columns: parsing, distances, lattices, projections and cell sizes."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from access_spark.functions.numeric import comma_number

EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.0
# Metres per degree used for cell sizes.
METRES_PER_DEGREE_LAT = 110_574.0
METRES_PER_DEGREE_LON = 111_320.0
# Fixed value: centroids of units above this area (a circle of 10 km radius) are high-bias.
HIGH_BIAS_AREA_KM2 = 314.0

# Fixed pattern: degrees, minutes, optional seconds, optional hemisphere.
_DMS = (
    r"^(-?\d+(?:[.,]\d+)?)[°º\s]+(\d+(?:[.,]\d+)?)['’\s]+([\d.,]+)?"
    r'["″\s]*([NSEWnsew])?'
)


def dms_to_degrees(col: Column) -> Column:
    """Decimal degrees from a plain number or from degree, minute, second text."""
    text = F.trim(col.cast("string"))

    def group(i: int) -> Column:
        return F.regexp_extract(text, _DMS, i)

    degrees, minutes = comma_number(group(1)), comma_number(group(2))
    seconds = F.when(group(3) == "", F.lit(0.0)).otherwise(comma_number(group(3)))
    size = F.abs(degrees) + minutes / 60.0 + seconds / 3600.0
    negative = F.upper(group(4)).isin("S", "W") | (degrees < 0)
    marked = F.when(text.rlike(_DMS), F.when(negative, -size).otherwise(size))

    parts = F.split(F.replace(text, F.lit(","), F.lit(".")), r"\s+")
    d, m, s = (comma_number(F.get(parts, F.lit(i))) for i in range(3))
    spaced_size = F.abs(d) + m / 60.0 + s / 3600.0
    spaced_negative = F.coalesce(F.upper(F.get(parts, F.lit(3))).isin("S", "W"), F.lit(False)) | (d < 0)
    spaced = F.when(spaced_negative, -spaced_size).otherwise(spaced_size)
    return F.coalesce(comma_number(text), marked, spaced)


def last_number(col: Column, force_west: bool = False) -> Column:
    """Last decimal number in a messy text; west-only longitudes are made negative."""
    compact = F.replace(F.trim(col.cast("string")), F.lit(" "), F.lit(""))
    found = F.regexp_extract_all(compact, F.lit(r"(-?\d+(?:[.,]\d+)?)"), F.lit(1))
    value = comma_number(F.get(found, F.size(found) - 1))
    return -F.abs(value) if force_west else value


def split_pair(col: Column) -> tuple[Column, Column]:
    """'lat, lon' text to two columns; both null unless both parse."""
    parts = F.split(col.cast("string"), ",")
    lat, lon = comma_number(F.get(parts, F.lit(0))), comma_number(F.get(parts, F.lit(1)))
    both = lat.isNotNull() & lon.isNotNull()
    return F.when(both, lat), F.when(both, lon)


def within(col: Column, low: float, high: float) -> Column:
    """The value when inside the limits, else null."""
    return F.when(col.between(low, high), col)


def in_box(lat: Column, lon: Column, box: Column) -> Column:
    """Inclusive bounding-box test; a missing coordinate or box gives false."""
    inside = lat.between(box["lat_min"], box["lat_max"]) & lon.between(box["lon_min"], box["lon_max"])
    return F.coalesce(inside, F.lit(False))


def looks_swapped(lat: Column, lon: Column, box: Column) -> Column:
    """Outside the box, but inside once latitude and longitude change places."""
    crossed = lat.between(box["lon_min"], box["lon_max"]) & lon.between(box["lat_min"], box["lat_max"])
    return ~in_box(lat, lon, box) & F.coalesce(crossed, F.lit(False))


def haversine_km(
    lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_RADIUS_KM
) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2.0
    half_lon = F.radians(lon2 - lon1) / 2.0
    chord = (
        F.sin(half_lat) * F.sin(half_lat)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_lon) * F.sin(half_lon)
    )
    return 2.0 * radius * F.asin(F.sqrt(F.when(chord > 1.0, 1.0).otherwise(chord)))


def degree_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = lat1 - lat2, lon1 - lon2
    return F.sqrt(dlat * dlat + dlon * dlon)


def degrees_to_km(col: Column) -> Column:
    return col * KM_PER_DEGREE


def cell_area_km2(lat: Column, pitch: float) -> Column:
    """Area of a square lattice cell, narrowing with latitude."""
    side = pitch * KM_PER_DEGREE
    return side * side * F.cos(F.radians(lat))


def cell_height_m(pitch_lat: float) -> float:
    return abs(pitch_lat) * METRES_PER_DEGREE_LAT


def cell_width_m(pitch_lon: float, mean_lat: Column) -> Column:
    return abs(pitch_lon) * METRES_PER_DEGREE_LON * F.cos(F.radians(mean_lat))


def lattice_index(value: Column, reference: Column, pitch: float) -> Column:
    """Whole lattice step nearest to a coordinate (half to even); null stays null."""
    return F.rint((value - reference) / pitch).cast("bigint")


def floor_cell(value: Column, origin: float, step: float) -> Column:
    """Raster row or column by rounding down."""
    return F.floor((value - origin) / step).cast("bigint")


def truncated_cell(value: Column, origin: float, step: float) -> Column:
    """Raster row or column by cutting towards zero: one cell before the origin reads cell 0."""
    return ((value - origin) / step).cast("bigint")


def centroid_bias(area_km2: Column) -> Column:
    return F.when(area_km2 > HIGH_BIAS_AREA_KM2, F.lit("high")).otherwise(F.lit("normal"))


def mercator_to_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    """Spherical Web Mercator metres to (lat, lon) degrees."""
    radius = 6378137.0
    lat = F.degrees(2.0 * F.atan(F.exp(y / radius)) - math.pi / 2.0)
    return lat, F.degrees(x / radius)


def utm_to_degrees(easting: Column, northing: Column, zone: int, south: bool) -> tuple[Column, Column]:
    """Universal Transverse Mercator metres to (lat, lon), third-order Krüger series."""
    axis, flattening, scale = 6378137.0, 1 / 298.257223563, 0.9996
    n = flattening / (2 - flattening)
    rectifying = axis / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96,
        n**2 / 48 + n**3 / 15,
        17 * n**3 / 480,
    )
    delta = (
        2 * n - 2 * n**2 / 3 - 2 * n**3,
        7 * n**2 / 3 - 8 * n**3 / 5,
        56 * n**3 / 15,
    )
    xi = (northing - (10_000_000.0 if south else 0.0)) / (scale * rectifying)
    eta = (easting - 500_000.0) / (scale * rectifying)
    xi1, eta1 = xi, eta
    for j, b in enumerate(beta, start=1):
        xi1 = xi1 - b * F.sin(2.0 * j * xi) * F.cosh(2.0 * j * eta)
        eta1 = eta1 - b * F.cos(2.0 * j * xi) * F.sinh(2.0 * j * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi
    for j, d in enumerate(delta, start=1):
        lat = lat + d * F.sin(2.0 * j * chi)
    lon = F.atan2(F.sinh(eta1), F.cos(xi1))
    return F.degrees(lat), F.degrees(lon) + float(zone * 6 - 183)

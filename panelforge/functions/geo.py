"""Coordinates, boxes and polylines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_KM = 6371.0

# Fixed values: (south, north, west, east) of the monitored cities.
CITY_BOXES = {"hanoi": (20.9, 21.1, 105.7, 106.0), "hcmc": (10.5, 10.9, 106.5, 107.0)}
CITY_CENTRES = {"hanoi": (21.0278, 105.8342), "hcmc": (10.7769, 106.7009)}

POINT = "struct<lon:double,lat:double>"


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    south, north, west, east = box
    return lat.between(south, north) & lon.between(west, east)


def in_own_city(city: Column, lat: Column, lon: Column, boxes: dict = CITY_BOXES) -> Column:
    """True when the point lies in the box of the city the row names."""
    out = F.lit(False)
    for name, box in boxes.items():
        out = out | ((city == name) & in_box(lat, lon, box))
    return out


def city_of_point(lat: Column, lon: Column, boxes: dict = CITY_BOXES) -> Column:
    """First city whose box holds the point, else null."""
    return F.coalesce(*[F.when(in_box(lat, lon, box), F.lit(name)) for name, box in boxes.items()])


def pseudo_offset(identity: Column, position: int, scale: float = 0.08) -> Column:
    """Stable offset in ±scale/2 taken from eight hex digits of the id's sha1."""
    digits = F.substring(F.sha1(identity), 1 + 8 * position, 8)
    return (F.conv(digits, 16, 10).cast("double") / 4294967295.0 - 0.5) * scale


def pseudo_coordinates(city: Column, segment: Column, centres: dict = CITY_CENTRES) -> tuple[Column, Column]:
    """Latitude and longitude for a segment that carries none, near its city's centre."""
    default = next(iter(centres.values()))
    lat0, lon0 = F.lit(default[0]), F.lit(default[1])
    for name, (lat, lon) in centres.items():
        lat0 = F.when(city == name, lat).otherwise(lat0)
        lon0 = F.when(city == name, lon).otherwise(lon0)
    return lat0 + pseudo_offset(segment, 0), lon0 + pseudo_offset(segment, 1)


def _point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))


def point_line(lat: Column, lon: Column, offset: float = 0.006) -> Column:
    """Three-point diagonal through a coordinate."""
    return F.array(_point(lon - offset, lat - offset), _point(lon, lat), _point(lon + offset, lat + offset))


def line_points(geometry: Column) -> Column:
    """LineString text with {"latitude","longitude"} or [lon,lat] vertices → points; null below two."""
    named = F.from_json(geometry, "coordinates array<struct<latitude:double,longitude:double>>")["coordinates"]
    pairs = F.from_json(geometry, "coordinates array<array<double>>")["coordinates"]
    from_named = F.filter(
        F.transform(named, lambda p: _point(p["longitude"], p["latitude"])),
        lambda p: p["lon"].isNotNull() & p["lat"].isNotNull(),
    )
    from_pairs = F.filter(
        F.transform(pairs, lambda p: _point(F.get(p, 0), F.get(p, 1))),
        lambda p: p["lon"].between(-180, 180) & p["lat"].between(-90, 90),
    )
    usable = lambda points: F.when(F.size(points) >= 2, points)
    return F.coalesce(usable(from_named), usable(from_pairs))


def any_vertex_in(points: Column, box: tuple[float, float, float, float]) -> Column:
    """Viewport test; ``box`` is (min lon, min lat, max lon, max lat)."""
    min_lon, min_lat, max_lon, max_lat = box
    return F.exists(points, lambda p: p["lon"].between(min_lon, max_lon) & p["lat"].between(min_lat, max_lat))


def parse_viewport(text: str) -> tuple[float, float, float, float]:
    """``minLon,minLat,maxLon,maxLat`` → numbers; raises when it is not an ordered box."""
    parts = text.split(",")
    if len(parts) != 4:
        raise ValueError("viewport must be minLon,minLat,maxLon,maxLat")
    west, south, east, north = (float(p) for p in parts)
    if west >= east or south >= north:
        raise ValueError("viewport minimum must lie below its maximum")
    return west, south, east, north


def line_legs(points: Column) -> Column:
    """Consecutive vertex pairs as array<struct<a,b>>."""
    heads = F.slice(points, F.lit(1), F.size(points) - 1)
    tails = F.slice(points, F.lit(2), F.size(points) - 1)
    return F.zip_with(heads, tails, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def chunk_count(leg: Column, road_type: Column, zoom: int) -> Column:
    """Pieces of a leg: 1 to 6 by length, zoom level and road type."""
    base = 1.2 if zoom <= 12 else 0.85 if zoom <= 14 else 0.55
    target = F.when(road_type == "Highway", base * 1.25).when(road_type == "Collector", base * 0.85).otherwise(base)
    length = haversine_km(leg["a"]["lat"], leg["a"]["lon"], leg["b"]["lat"], leg["b"]["lon"])
    return F.greatest(F.lit(1), F.least(F.lit(6), F.ceil(length / target).cast("int")))


def split_leg(leg: Column, count: Column) -> Column:
    """Equal pieces of a leg as array<struct<a,b>>."""

    def at(step: Column) -> Column:
        share = step / count
        return _point(
            leg["a"]["lon"] + (leg["b"]["lon"] - leg["a"]["lon"]) * share,
            leg["a"]["lat"] + (leg["b"]["lat"] - leg["a"]["lat"]) * share,
        )

    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(at(i).alias("a"), at(i + 1).alias("b")))

"""Batch readers. Schemas are given, so a read is one pass with pruning and pushdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from panelforge.functions import numeric as nm
from panelforge.sources import schemas

BAD = "_corrupt"


def read_jsonl(spark: SparkSession, path: str, schema: str, glob: str = "*.jsonl") -> tuple[DataFrame, DataFrame]:
    """(valid rows, malformed lines) of a JSON-lines folder. Nested ``raw`` objects arrive as text."""
    lines = spark.read.option("pathGlobFilter", glob).text(path).filter(F.trim("value") != "")
    return split_json(lines, F.col("value"), schema)


def split_json(lines: DataFrame, value: Column, schema: str) -> tuple[DataFrame, DataFrame]:
    """Parse JSON text once; rows that do not parse keep their text and an error."""
    full = f"{schema}, {BAD} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    parsed = lines.withColumns({"_line": value, "_r": F.from_json(value, full, options)})
    extra = [c for c in lines.columns if c != "value"]
    bad = F.col("_r").isNull() | F.col(f"_r.{BAD}").isNotNull()
    good = parsed.filter(~bad).select("_r.*", *extra).drop(BAD)
    wrong = parsed.filter(bad).select(F.col("_line").alias("original_value"), F.lit("malformed JSON").alias("error"), *extra)
    return good, wrong


def read_traffic(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> DataFrame:
    """Traffic JSONL, both layouts: ``timestamp`` stands in for ``event_time``, jam and geometry are derived."""
    rows, _ = read_jsonl(spark, path, schemas.TRAFFIC_RAW, pattern)
    jam = F.coalesce("jamFactor", nm.jam_factor(F.col("currentSpeed"), F.col("freeFlowSpeed")))
    return rows.withColumns(
        {
            "event_time": F.coalesce("event_time", "timestamp"),
            "time_bucket": F.coalesce("time_bucket", "event_time", "timestamp"),
            "jamFactor": jam,
            "geometry": F.coalesce("geometry", payload_geometry(F.col("raw"))),
        }
    ).drop("timestamp", "raw")


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Weather JSONL, both layouts."""
    rows, _ = read_jsonl(spark, path, schemas.WEATHER_RAW)
    return rows.withColumns(
        {
            "event_time": F.coalesce("event_time", "timestamp"),
            "time_bucket": F.coalesce("time_bucket", "event_time", "timestamp"),
            "weather_cell_id": F.coalesce("weather_cell_id", "point_id"),
            "rain_1h": F.coalesce("rain_1h", F.lit(0.0)),
        }
    ).drop("timestamp", "point_id", "raw")


def read_news(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> DataFrame:
    """News JSONL with the raw line, its file and a record id that does not depend on how files are split.

    The id hashes the file's path below ``path`` (so a moved folder keeps its ids), the line and which of its occurrences in the
    file this is; Spark knows no line numbers. Equal lines of a file are counted first and numbered afterwards.
    """
    lines = spark.read.option("pathGlobFilter", pattern).text(path).filter(F.trim("value") != "")
    # A glob or a single file is no part of its files' paths: these keep their whole path.
    below = F.substring_index("_metadata.file_path", path.rstrip("/") + "/", -1)
    counted = lines.groupBy("value", below.alias("source_file")).agg(F.count(F.lit(1)).alias("_n"))
    numbered = counted.select("value", "source_file", F.col("value").alias("raw_payload_json"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_occurrence"))
    rows, _ = split_json(numbered, F.col("value"), schemas.NEWS_RAW)
    return rows.withColumn("record_id", F.sha1(F.concat_ws(":", "source_file", "_occurrence", "raw_payload_json"))).drop("_occurrence")


FLOW = (
    "flowSegmentData struct<currentSpeed:double,freeFlowSpeed:double,currentTravelTime:int,freeFlowTravelTime:int,"
    "confidence:double,jamFactor:double,roadClosure:boolean,"
    "coordinates:struct<coordinate:array<struct<latitude:double,longitude:double>>>>"
)


def flow_points(raw: Column) -> Column:
    """Vertices of a flow payload."""
    return F.from_json(raw, FLOW)["flowSegmentData"]["coordinates"]["coordinate"]


def payload_geometry(raw: Column) -> Column:
    """LineString text of a flow payload, null without vertices."""
    points = flow_points(raw)
    line = F.to_json(F.struct(F.lit("LineString").alias("type"), points.alias("coordinates")))
    return F.when(F.size(points) > 0, line)


def flatten_flow(df: DataFrame, raw: str, lat: str, lon: str, keep: list[str]) -> DataFrame:
    """Flow payloads → traffic columns; the last vertex gives the position, else the point that was asked for."""
    flow = F.from_json(F.col(raw), FLOW)["flowSegmentData"]
    base = df.withColumn("_f", flow).filter(F.col("_f.currentSpeed").isNotNull() & F.col("_f.freeFlowSpeed").isNotNull())
    last = F.try_element_at(F.col("_f.coordinates.coordinate"), F.lit(-1))
    speed, free = F.col("_f.currentSpeed"), F.col("_f.freeFlowSpeed")
    return base.select(
        *keep, F.coalesce(last["latitude"], F.col(lat)).alias("lat"), F.coalesce(last["longitude"], F.col(lon)).alias("lon"),
        payload_geometry(F.col(raw)).alias("geometry"), speed.alias("currentSpeed"), free.alias("freeFlowSpeed"),
        F.coalesce(F.col("_f.jamFactor"), nm.jam_factor(speed, free)).alias("jamFactor"),
        F.col("_f.confidence").alias("confidence"), F.coalesce("_f.roadClosure", F.lit(False)).alias("roadClosure"),
    )


WEATHER_PAYLOAD = (
    "dt long, main struct<temp:double,feels_like:double,humidity:int,pressure:int>, wind struct<speed:double,deg:int>, "
    "rain struct<`1h`:double>, clouds struct<`all`:int>, visibility int, "
    "weather array<struct<id:int,main:string,description:string>>"
)


def flatten_weather(df: DataFrame, raw: str, keep: list[str]) -> DataFrame:
    """Weather payloads → weather columns; no rain block means 0."""
    base = df.withColumn("_w", F.from_json(F.col(raw), WEATHER_PAYLOAD))
    first = F.get(F.col("_w.weather"), 0)
    return base.select(
        *keep, F.timestamp_seconds("_w.dt").alias("event_time"), F.col("_w.main.temp").alias("temp"),
        F.col("_w.main.feels_like").alias("feels_like"), F.col("_w.main.humidity").alias("humidity"),
        F.col("_w.main.pressure").alias("pressure"), first["id"].alias("weather_id"), first["main"].alias("weather_main"),
        first["description"].alias("weather_desc"), F.col("_w.visibility").alias("visibility"),
        F.coalesce(F.col("_w.rain.1h"), F.lit(0.0)).alias("rain_1h"), F.col("_w.wind.speed").alias("wind_speed"),
        F.col("_w.wind.deg").alias("wind_deg"), F.col("_w.clouds.all").alias("clouds"),
    )


TRAFFIC_TYPES = {
    **{n: "string" for n in ("source", "provider", "city", "segment_id", "segment_name", "weather_cell_id")},
    **{n: "double" for n in ("lat", "lon")},
    **{n: "timestamp" for n in ("event_time", "ingestion_time", "time_bucket")},
    **{n: "double" for n in ("currentSpeed", "freeFlowSpeed", "jamFactor", "confidence")},
    "roadClosure": "boolean",
}
WEATHER_TYPES = {
    **{n: "string" for n in ("source", "provider", "city", "weather_cell_id")},
    **{n: "double" for n in ("lat", "lon")},
    **{n: "timestamp" for n in ("event_time", "ingestion_time", "time_bucket")},
    **{n: "double" for n in ("temp", "feels_like")},
    **{n: "int" for n in ("humidity", "pressure", "visibility")},
    **{n: "double" for n in ("rain_1h", "wind_speed")},
    "wind_deg": "int",
    **{n: "string" for n in ("weather_main", "weather_desc")},
}


def to_standard(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Select and cast to a standard table; absent columns become null, bad values too."""
    have = set(df.columns)
    cast = lambda n, t: F.col(n).try_cast(t) if n in have else F.lit(None).cast(t)
    return df.select(*[cast(n, t).alias(n) for n, t in types.items()])


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with header from a file, folder or glob; types are inferred when no schema is given."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_tagged(spark: SparkSession, path: str, tag: str, fmt: str = "csv") -> DataFrame:
    """Named dataset import with its source tag."""
    df = read_csv(spark, path) if fmt == "csv" else spark.read.parquet(path)
    return df.withColumn("_source", F.lit(tag))


def read_first(spark: SparkSession, base: str) -> DataFrame:
    """``base.csv`` if it exists, else ``base.parquet``; decided while planning."""
    for suffix, read in ((".csv", lambda p: read_csv(spark, p)), (".parquet", spark.read.parquet)):
        try:
            return read(base + suffix)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"neither {base}.csv nor {base}.parquet exists")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog name or Parquet path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def optional_table(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or None when the catalog does not know it."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def monitoring_points(points: DataFrame, city: str = "all", offset: int = 0, limit: int | None = None) -> DataFrame:
    """Points of a city in id order, paged."""
    if offset < 0:
        raise ValueError("offset must not be negative")
    kept = points if city == "all" else points.filter(F.lower("city") == city.lower().strip())
    paged = kept.orderBy("city", "segment_id").offset(offset)
    return paged if limit is None else paged.limit(limit)


def road_segments(edges: DataFrame, city: str, order: list[str]) -> DataFrame:
    """Road edges → segment dimension: id by content hash, geometry as WKT.

    A running row number would need one sorted task over all edges; a hash of the edge is as unique
    and stays the same when edges are added.
    """
    wkt = F.concat(F.lit("LINESTRING ("), F.array_join(
        F.transform("points", lambda p: F.concat_ws(" ", p["lon"].cast("string"), p["lat"].cast("string"))), ", "), F.lit(")"))
    identity = F.sha1(F.concat_ws("|", *[F.col(c).cast("string") for c in order]))
    return edges.select(
        F.concat_ws("_", F.lit(city.lower().replace(" ", "_")), identity).alias("segment_id"), F.lit(city).alias("city"),
        "highway", wkt.alias("geometry_wkt"), F.lit("openstreetmap").alias("source"),
    )


def percentile_stats(stats: DataFrame, fetched_at: Column) -> DataFrame:
    """Statistics table (segment_id, p15, p50, p85 …) → lookup rows, missing values 0."""
    zero = lambda n: F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(f"{n}_percentile")
    source = F.coalesce("source", F.lit("tomtom-stats")) if "source" in stats.columns else F.lit("tomtom-stats")
    return stats.select("segment_id", zero("p15"), zero("p50"), zero("p85"), source.alias("source"), fetched_at.alias("fetched_at"))


def with_lineage(df: DataFrame, source: str, now: Column | None = None) -> DataFrame:
    """Ingest time, source tag and the date columns it is partitioned by."""
    now = F.current_timestamp() if now is None else now
    return df.withColumns(
        {"_ingested_at": now, "_source": F.lit(source), "_year": F.year(now), "_month": F.month(now), "_day": F.dayofmonth(now)}
    )


def with_prefix(df: DataFrame, prefix: str, keep: list[str]) -> DataFrame:
    """Prefix every column but the join keys."""
    return df.select([F.col(c).alias(c if c in keep else prefix + c) for c in df.columns])

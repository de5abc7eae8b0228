"""GeoJSON read in parallel: features are cut out of the text by bracket depth, whatever line
breaks it has; rings become directed edges.

The text is read up to every closing brace, so splits of a file are read by several tasks. Two
running sums over the pieces (quotes, then braces outside of strings) tell where a feature
ends; each is summed inside the splits and shifted by one row per split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from access_spark.session import cut_lineage

_SPLIT = ["_file", "_split"]


def _running(rows: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Add, under each name, the sum of an expression over all earlier pieces of the file.

    A window holds one split of a file at most; one row of each split crosses the borders.
    """
    held = rows.withColumns({f"_of_{n}": e.cast("bigint") for n, e in sums.items()})
    inside = Window.partitionBy(*_SPLIT).orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    totals = held.groupBy(*_SPLIT).agg(*[F.sum(f"_of_{n}").alias(f"_of_{n}") for n in sums])
    starts = totals.select(*_SPLIT, *[F.coalesce(F.sum(f"_of_{n}").over(earlier), F.lit(0)).alias(f"_start_{n}") for n in sums])
    held = held.withColumns({n: F.coalesce(F.sum(f"_of_{n}").over(inside), F.lit(0)) for n in sums}).join(starts, _SPLIT)
    return held.withColumns({n: F.col(f"_start_{n}") + F.col(n) for n in sums}).drop(*[f"_of_{n}" for n in sums], *[f"_start_{n}" for n in sums])


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def feature_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, row_seq, feature): the JSON text of every feature of feature collections.

    row_seq rises in file order, starting at 0 with the first member that is an object; other
    members of the collection take a number and are left out. Braces inside strings and
    escaped quotes do not count. `path` may name many files.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_id"), "value",
    )
    pieces = cut_lineage(pieces)
    bare = F.regexp_replace("value", r"\\.", "")  # an escaped character opens and closes nothing
    rows = _running(pieces.withColumn("_bare", bare), {"_quotes": _count(F.col("_bare"), '"')})
    opened = F.col("_quotes") % 2 == 1
    begun = F.when(opened, F.regexp_replace("_bare", r'(?s)^[^"]*("|$)', "")).otherwise(F.col("_bare"))
    outside = F.regexp_replace(begun, r'(?s)"[^"]*("|$)', "")
    ends_inside = (F.col("_quotes") + _count(F.col("_bare"), '"')) % 2 == 1
    rows = rows.withColumns({"_up": _count(outside, "{"), "_down": F.when(ends_inside, 0).otherwise(1)})
    rows = _running(rows, {"_depth": F.col("_up") - F.col("_down")})
    closes = (F.col("_depth") + F.col("_up") == 2) & (F.col("_down") == 1)
    rows = _running(rows.withColumn("_closes", closes.cast("int")), {"row_seq": F.col("_closes")})
    parts = F.array_sort(F.collect_list(F.struct("_id", "value")))
    whole = rows.groupBy(F.col("_file").alias("file"), "row_seq").agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "}").alias("t"), F.max("_closes").alias("whole")
    ).filter("whole = 1")
    # what comes before a member: the head of the collection, or a separator
    member = F.regexp_replace("t", r'(?s)^\s*\{?[^{]*"features"\s*:\s*\[', "")
    member = F.concat(F.regexp_replace(member, r"(?s)^[\s,\]]*", ""), F.lit("}"))
    return whole.select("file", "row_seq", member.alias("feature")).filter(F.get_json_object("feature", "$.type") == "Feature")


def read_features(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """(row_seq, properties, geometry type, coordinates as text) of every feature; `properties`
    are the wanted fields of that object, as a schema. Numbers of several files rise file by file."""
    schema = f"properties struct<{properties}>, geometry struct<type: string, coordinates: string>"
    rows = feature_texts(spark, path).select("file", "row_seq", F.from_json("feature", schema).alias("f"))
    files = rows.groupBy("file").agg((F.max("row_seq") + 1).alias("_n"))  # one row per file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return rows.join(starts, "file").select(
        (F.col("_start") + F.col("row_seq")).alias("row_seq"), F.col("f.properties").alias("properties"),
        F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"),
    )


def read_geojson_points(spark: SparkSession, path: str, key: str = "id_centro") -> DataFrame:
    """Feature ids with coordinates from the properties, else from the point geometry."""
    features = read_features(spark, path, f"`{key}`: string, latitud: double, longitud: double")
    point = F.when(F.col("kind") == "Point", F.from_json("coordinates", "array<double>"))
    lat, lon = F.col("properties.latitud"), F.col("properties.longitud")
    given = lat.isNotNull() & lon.isNotNull()
    return features.select(
        "row_seq", F.col(f"properties.`{key}`").alias(key),
        F.when(given, lat).otherwise(F.get(point, F.lit(1))).alias("latitud"),
        F.when(given, lon).otherwise(F.get(point, F.lit(0))).alias("longitud"),
    ).filter("latitud IS NOT NULL AND longitud IS NOT NULL")


def ring_edges(features: DataFrame) -> DataFrame:
    """Edges of polygon and multipolygon features: the columns of `features` but coordinates,
    with part, ring (0: outer), place and sx, sy, ex, ey.

    Outer rings run counterclockwise and holes clockwise, whatever the file says, so signed
    sums over the edges are right; an open ring is closed; rings of less than three different
    points and other geometries give no edges.
    """
    parts = F.when(F.col("kind") == "Polygon", F.array(F.from_json("coordinates", "array<array<array<double>>>"))).when(
        F.col("kind") == "MultiPolygon", F.from_json("coordinates", "array<array<array<array<double>>>>")
    )
    kept = [c for c in features.columns if c != "coordinates"]
    rings = features.select(*kept, F.posexplode(parts).alias("part", "_rings")).select(*kept, "part", F.posexplode("_rings").alias("ring", "_p"))
    rings = rings.withColumn("_p", F.when(F.element_at("_p", 1) == F.element_at("_p", -1), F.col("_p")).otherwise(F.concat("_p", F.slice("_p", 1, 1))))
    rings = rings.filter(F.size(F.array_distinct("_p")) >= 3)

    def edge(points: str) -> Column:
        ends = F.slice(points, 2, F.size(points))
        return F.zip_with(F.slice(points, 1, F.size(points) - 1), ends, lambda a, b: F.struct(a[0].alias("sx"), a[1].alias("sy"), b[0].alias("ex"), b[1].alias("ey")))

    area = F.aggregate(edge("_p"), F.lit(0.0), lambda s, e: s + e["sx"] * e["ey"] - e["ex"] * e["sy"])
    turned = F.when((area < 0) == (F.col("ring") == 0), F.reverse("_p")).otherwise(F.col("_p"))
    rings = rings.withColumn("_p", turned)
    return rings.select(*kept, "part", "ring", F.posexplode(edge("_p")).alias("place", "e")).select(*kept, "part", "ring", "place", "e.*")

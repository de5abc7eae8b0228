"""Table maintenance: partition upserts, ledgers, publication and exports.

Tables are Parquet folders. A new version is written beside the old one and swapped in by
rename, so a failed job leaves the published table as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from access_spark import config
from access_spark.operators.keyed import DuplicateKeyError, duplicate_keys, keep_first, keep_last, union_columns
from access_spark.plans.finalize import conform
from access_spark.session import cut_lineage


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _fs(spark, path)
    return fs.exists(hadoop)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The stored table, or no rows of the given schema when it does not exist."""
    if table_exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a new version of a table and swap it in by rename."""
    spark = df.sparkSession
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(staging)
    fs, target = _fs(spark, path)
    _, fresh = _fs(spark, staging)
    old = None
    if fs.exists(target):
        _, old = _fs(spark, f"{path}.old-{uuid.uuid4().hex}")
        if not fs.rename(target, old):
            fs.delete(fresh, True)
            raise OSError(f"{path}: the old version could not be moved, nothing was changed")
    if not fs.rename(fresh, target):
        if old is not None:
            fs.rename(old, target)
        raise OSError(f"{path}: the new version could not be moved, the old one is back")
    if old is not None:
        fs.delete(old, True)


def upsert_partitions(existing: DataFrame | None, new: DataFrame, key: str = "iso") -> DataFrame:
    """Replace the partitions that occur in `new`, keep the others; columns are the
    existing ones followed by new ones."""
    if key not in new.columns:
        raise ValueError(f"upsert: column {key} missing from the new rows")
    if existing is None or key not in existing.columns:
        return new
    kept = existing.join(new.select(key).distinct(), key, "left_anti").select(*existing.columns)
    return union_columns(kept, new)


# ---- the published cube: versions of countries under a manifest -----------------------------
#
# <path>/data/version=<id>/isoalpha3=<country>/...   written once, never changed
# <path>/manifest/<number>.json                      country -> version; the highest counts


def _manifests(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _fs(spark, f"{path}/manifest")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest(spark: SparkSession, path: str, number: int) -> dict[str, str]:
    rows = spark.read.text(f"{path}/manifest/{number:012d}.json", wholetext=True).collect()
    return json.loads(rows[0][0])


def _add_manifest(spark: SparkSession, path: str, number: int, versions: Mapping[str, str]) -> bool:
    """Put a manifest in place by one rename, which fails if that number is taken."""
    fs, target = _fs(spark, f"{path}/manifest/{number:012d}.json")
    _, staged = _fs(spark, f"{path}/manifest/.{uuid.uuid4().hex}")
    out = fs.create(staged, False)
    try:
        out.write(bytearray(json.dumps(dict(versions), sort_keys=True).encode()))
    finally:
        out.close()
    if not fs.exists(target) and fs.rename(staged, target):
        return True
    fs.delete(staged, False)
    return False


def write_cube(new: DataFrame, path: str) -> bool:
    """Publish the countries of `new`; refuses repeated keys, leaves the cube alone when there
    is nothing to write. Returns whether something was written.

    Only the files of these countries are written. They become visible with one renamed
    manifest, so a reader sees all of the old rows of a country or all of the new ones, and a
    failed job leaves the cube as it was. If another writer comes first, its manifest is taken
    over and the next number tried.
    """
    spark = new.sparkSession
    new = cut_lineage(new.select(*config.CUBE_COLUMNS))  # read several times: countries, key test and write
    countries = [r[0] for r in new.select("isoalpha3").distinct().collect()]
    if not countries:
        return False
    if None in countries:
        raise ValueError(f"{path}: rows without a country, nothing written")
    if not duplicate_keys(new, config.CUBE_KEY).isEmpty():
        raise DuplicateKeyError(f"{path}: repeated cube keys, nothing written")
    version = uuid.uuid4().hex
    # range partitioning and sorting give a stable order on disk
    ordered = new.repartitionByRange(*config.CUBE_KEY).sortWithinPartitions(*config.CUBE_KEY)
    ordered.write.mode("errorifexists").partitionBy("isoalpha3").parquet(f"{path}/data/version={version}")
    for _ in range(100):
        numbers = _manifests(spark, path)
        held = _manifest(spark, path, numbers[-1]) if numbers else {}
        if _add_manifest(spark, path, numbers[-1] + 1 if numbers else 1, held | dict.fromkeys(countries, version)):
            return True
    raise OSError(f"{path}: other writers were always faster, nothing published")


def read_cube(spark: SparkSession, path: str, countries: Sequence[str] | None = None) -> DataFrame:
    """The published cube, or some of its countries; only their files are listed and read.
    No cube or no such country means no rows."""
    numbers = _manifests(spark, path)
    held = _manifest(spark, path, numbers[-1]) if numbers else {}
    chosen = {c: v for c, v in held.items() if countries is None or c in countries}
    types = {"value": "double", "population_base": "double", "year": "int"}
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in config.CUBE_COLUMNS)
    if not chosen:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/data/version={v}/isoalpha3={c}" for c, v in sorted(chosen.items())]
    stored = spark.read.schema(schema).option("basePath", f"{path}/data/").parquet(*folders)
    return stored.select(*config.CUBE_COLUMNS)


def vacuum_cube(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the manifests before the last `keep` and the files that none of those names.
    Returns the number of deleted country folders. Readers older than that may lose files."""
    numbers = _manifests(spark, path)
    wanted = {(v, c) for n in numbers[-keep:] for c, v in _manifest(spark, path, n).items()}
    fs, data = _fs(spark, f"{path}/data")
    gone = 0
    for version in fs.listStatus(data) if fs.exists(data) else []:
        parts = [p for p in fs.listStatus(version.getPath()) if p.getPath().getName().startswith("isoalpha3=")]
        old = [p for p in parts if (version.getPath().getName()[8:], p.getPath().getName()[10:]) not in wanted]
        for part in old:
            fs.delete(part.getPath(), True)
        gone += len(old)
        if len(old) == len(parts):
            fs.delete(version.getPath(), True)
    for n in numbers[:-keep]:
        fs.delete(_fs(spark, f"{path}/manifest/{n:012d}.json")[1], False)
    return gone


def merge_ledger(existing: DataFrame, run: DataFrame, keys: Sequence[str] = ("iso", "id_centro")) -> DataFrame:
    """Append a run to the ledger, the latest row per school stays; both sides carry run_seq.
    Of rows with the same run_seq the one of the run stays."""
    both = union_columns(existing.withColumn("_run", F.lit(0)), run.withColumn("_run", F.lit(1)))
    return keep_last(both, keys, F.struct("run_seq", "_run")).drop("_run")


def latest(ledger: DataFrame, keys: Sequence[str] = ("iso", "id_centro")) -> DataFrame:
    return keep_last(ledger, keys, F.col("run_seq"))


def rebuild_base(rebuilt: DataFrame, existing: DataFrame | None, order: Column | None = None) -> DataFrame:
    """Registry rebuilt from raw: base columns are new, every other column carries over by
    id from the first earlier row."""
    base = conform(rebuilt, config.BASE_COLUMNS)
    if existing is None:
        return base
    extra = [c for c in existing.columns if c not in config.BASE_COLUMNS and c != "row_seq"]
    if not extra:
        return base
    keyed = existing.withColumn("id_centro", F.trim("id_centro"))
    rows = keyed.select("id_centro", *extra, *(["row_seq"] if "row_seq" in keyed.columns else []))
    if order is not None:
        rows = keep_first(rows, ["id_centro"], order)
    return base.withColumn("id_centro", F.trim("id_centro")).join(rows.select("id_centro", *extra), "id_centro", "left")


def with_year_and_id(df: DataFrame, year: int) -> DataFrame:
    """Add `year` and `id_national` where the table lacks them."""
    if "year" not in df.columns:
        df = df.withColumn("year", F.lit(year))
    if "id_national" not in df.columns and "id_centro" in df.columns:
        df = df.withColumn("id_national", F.col("id_centro"))
    return df


def run_manifest(expected: DataFrame, rows: DataFrame, metrics: Mapping[str, Column], key: str = "iso") -> DataFrame:
    """One row per expected country with its metrics; no rows means it was skipped."""
    done = rows.groupBy(key).agg(*[c.alias(n) for n, c in metrics.items()], F.lit("ok").alias("_status"))
    return expected.select(key).distinct().join(done, key, "left").withColumn(
        "status", F.coalesce("_status", F.lit("skipped"))
    ).drop("_status")


def country_crosswalk(countries: DataFrame, codes: DataFrame, key: str, column: str) -> DataFrame:
    """Attach the boundary layer's code; a country without one stops the job."""
    joined = countries.join(codes, key, "left")
    problem = F.raise_error(F.concat(F.lit(f"no {column} for "), F.col(key)))
    return joined.withColumn(column, F.coalesce(column, problem.cast("string")))


def orphan_fills(registry: DataFrame, ledger: DataFrame) -> DataFrame:
    """Filled schools without an accepted fill in the ledger."""
    accepted = ledger.filter((F.col("target_type") == "fill") & F.col("acceptance").isin(*config.FILL_ACCEPTED))
    filled = registry.filter(F.col("coordinate_source") == "geocoded")
    return filled.join(accepted.select("iso", "id_centro").distinct(), ["iso", "id_centro"], "left_anti")


def repair_ledger(registry: DataFrame, ledger: DataFrame, run_seq: Column) -> DataFrame:
    """Ledger with rows rebuilt from the registry for fills it lost."""
    lost = orphan_fills(registry, ledger)
    have = set(lost.columns)

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in have else F.lit("")

    def value(*names: str) -> Column:
        found = [F.col(n).cast("double") for n in names if n in have]
        return F.coalesce(*found) if found else F.lit(None).cast("double")

    special = {
        "iso": F.col("iso"), "id_centro": F.col("id_centro"),
        "geocoded_lat": value("latitud_geocoded", "latitud"), "geocoded_lon": value("longitud_geocoded", "longitud"),
        "arcgis_score": value("arcgis_score"), "geocode_distance_km": value("geocode_distance_km"),
        "geocode_query": F.lit(""), "target_type": F.lit("fill"),
        "original_lat": F.lit(None).cast("double"), "original_lon": F.lit(None).cast("double"),
    }
    rebuilt = lost.select(*[special.get(c, text(c)).alias(c) for c in config.LEDGER_COLUMNS], run_seq.alias("run_seq"))
    return merge_ledger(ledger, rebuilt)


def export_mart(df: DataFrame, folder: str, name: str) -> None:
    """A mart as CSV and as JSON records."""
    df.write.mode("overwrite").option("header", True).csv(f"{folder}/csv/{name}")
    df.write.mode("overwrite").json(f"{folder}/json/{name}")


def bundle(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Marts as one table of (mart, record): each record is a JSON object.

    Records stay rows, so a bundle of any size is written in parallel.
    """
    parts = [df.select(F.lit(name).alias("mart"), F.to_json(F.struct("*")).alias("record")) for name, df in marts.items()]
    return union_columns(*parts)

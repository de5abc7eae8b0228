"""Readers for raw registries: delimited text, repaired text and stored matrices."""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from access_spark.functions.text import fuzzy_column
from access_spark.operators.keyed import number_rows
from access_spark.session import cut_lineage

# Spark decodes these by name; anything else is staged as UTF-8 beforehand.
ENCODINGS = {"latin-1": "ISO-8859-1", "iso-8859-1": "ISO-8859-1", "utf-8": "UTF-8", "utf-8-sig": "UTF-8"}


def _headers(columns: Sequence[str]) -> list[str]:
    return [c.replace("﻿", "").replace("ï»¿", "").strip() for c in columns]


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Lines with the split of the file they came from: (_file, _split, _id, line_no, value)."""
    name = ENCODINGS.get(encoding, encoding)
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_id"), F.decode(F.col("value").cast("binary"), name).alias("value"),
    )
    lines = cut_lineage(lines)
    splits = lines.groupBy("_file", "_split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    starts = splits.select("_file", "_split", "_first", F.coalesce(F.sum("_n").over(_earlier()), F.lit(0)).alias("_before"))
    line_no = F.col("_before") + F.col("_id") - F.col("_first")
    return lines.join(starts, ["_file", "_split"]).select("_file", "_split", "_id", line_no.alias("line_no"), "value")


def _earlier():
    """The splits before one; a file has one row for each."""
    return Window.orderBy("_file", "_split").rowsBetween(Window.unboundedPreceding, -1)


def numbered_lines(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """Lines of a file as (line_no, value), numbered from 0 in file order, blank ones too.

    Lines are read in parallel. Those of one split of the file have rising ids, so a line's
    number is its place in the split plus the lines of the splits before it, of which there
    is one row each.
    """
    return _lines(spark, path, encoding).select("line_no", "value")


def _patterns(sep: str) -> tuple[str, str]:
    """(an open quoted field at the end of a text, one field up to its separator).

    A quote opens a field only at its start. Inside, two quotes are one; after the closing
    quote the rest up to the separator belongs to the field as it is.
    """
    s = re.escape(sep)
    inside = '"[^"]*+(?:""[^"]*+)*+'
    field = f'{inside}"(?:[^"{s}][^{s}]*+)?|[^"{s}][^{s}]*+|'
    return f"(?s)^(?:(?:{field}){s})*+{inside}$", f"(?s)({field}){s}"


def _records(lines: DataFrame, sep: str) -> DataFrame:
    """Lines joined to records where a quoted field goes over a line break: (line_no, value),
    line_no being that of the first line.

    A line maps what it starts in (no field or an open quoted field) to what it ends in. The
    map of a line is constant, or keeps or swaps its argument; maps are composed inside each
    split and then over one row per split, so splits are worked on in parallel. A field that
    is never closed takes the rest of the file, as the csv module does.
    """
    if lines.filter(F.contains("value", F.lit('"'))).isEmpty():
        return lines.select("line_no", "value")
    opens, _ = _patterns(sep)
    plain, quoted = F.col("value").rlike(opens), F.concat(F.lit('"'), F.col("value")).rlike(opens)
    mapped = lines.withColumns({"_plain": plain, "_quoted": quoted})
    order = Window.partitionBy("_file", "_split").orderBy("line_no")
    before, here = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swap = (F.col("_plain") & ~F.col("_quoted")).cast("int")
    mapped = mapped.withColumns({"_swaps": F.sum(swap).over(here), "_fixed": F.col("_plain") == F.col("_quoted")})
    fixed = F.when(F.col("_fixed"), F.struct(F.col("_plain").alias("to"), F.col("_swaps").alias("at")))
    mapped = mapped.withColumns({"_known": F.last(fixed, True).over(before), "_so_far": F.coalesce(F.lag("_swaps").over(order), F.lit(0))})

    # what a split does to the state it starts in
    last = F.max_by(F.struct("_known", "_fixed", "_plain", "_swaps"), "line_no").alias("l")
    whole = mapped.groupBy("_file", "_split").agg(last).select("_file", "_split", "l.*")
    ends = F.when(F.col("_fixed"), F.col("_plain")).otherwise(F.col("_known.to") != ((F.col("_swaps") - F.col("_known.at")) % 2 == 1))
    whole = whole.select("_file", "_split", F.col("_swaps").alias("_turns"), ends.alias("_ends"))
    turned = F.coalesce(F.sum("_turns").over(_earlier()), F.lit(0))
    settled = F.last(F.when(F.col("_ends").isNotNull(), F.struct(F.col("_ends").alias("to"), F.col("_after").alias("at"))), True).over(_earlier())
    whole = whole.withColumn("_turned", turned).withColumn("_after", F.col("_turned") + F.col("_turns")).withColumn("_settled", settled)
    start = F.coalesce(F.col("_settled.to"), F.lit(False)) != ((F.col("_turned") - F.coalesce(F.col("_settled.at"), F.lit(0))) % 2 == 1)
    starts = whole.select("_file", "_split", start.alias("_start"))

    known = F.coalesce(F.col("_known.to"), F.col("_start")) != ((F.col("_so_far") - F.coalesce(F.col("_known.at"), F.lit(0))) % 2 == 1)
    rows = mapped.join(starts, ["_file", "_split"]).select("_file", "_split", "line_no", "value", known.alias("_inside"))
    first = F.when(~F.col("_inside"), F.col("line_no"))
    rows = rows.withColumn("_first", F.last(first, True).over(here))
    carried = rows.groupBy("_file", "_split").agg(F.max("_first").alias("_last")).select(
        "_file", "_split", F.max("_last").over(_earlier()).alias("_carried")
    )
    rows = rows.join(carried, ["_file", "_split"]).select(F.coalesce("_first", "_carried").alias("line_no"), F.col("line_no").alias("_at"), "value")
    parts = F.array_sort(F.collect_list(F.struct("_at", "value")))
    return rows.groupBy("line_no").agg(F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("value"))


def _fields(sep: str) -> Column:
    """Fields of a record: unquoted ones that are empty are null."""
    opens, field = _patterns(sep)
    text = F.when(F.col("value").rlike(opens), F.concat("value", F.lit('"'))).otherwise(F.col("value"))
    inner, rest = '(?s)^"([^"]*+(?:""[^"]*+)*+)".*$', '(?s)^"[^"]*+(?:""[^"]*+)*+"(.*)$'

    def bare(x: Column) -> Column:
        content = F.concat(F.replace(F.regexp_extract(x, inner, 1), F.lit('""'), F.lit('"')), F.regexp_extract(x, rest, 1))
        return F.when(x.startswith('"'), content).when(x != "", x)

    parts = F.regexp_extract_all(F.concat(text, F.lit(sep)), F.lit(field), F.lit(1))
    simple = F.transform(F.split("value", re.escape(sep), -1), lambda x: F.when(x != "", x))
    return F.when(F.contains("value", F.lit('"')), F.transform(parts, bare)).otherwise(simple)


def _parsed(lines: DataFrame, sep: str, skip: int, repair=lambda text: text) -> DataFrame:
    """Rows after `skip` title lines (blank ones count) and a header, with `row_seq`, their
    number in file order. Titles and header go by position, so equal data lines stay; blank
    data lines are no rows. Rows with fewer fields than the header are filled with nulls,
    further fields are left out. An empty file has no columns but row_seq."""
    head = lines.filter(F.col("line_no") == skip).first()
    if head is None:
        return lines.limit(0).select(F.col("line_no").alias("row_seq"))
    header = _headers(next(csv.reader([head["value"]], delimiter=sep)))
    body = lines.filter(F.col("line_no") > skip).withColumn("value", repair(F.col("value")))
    body = _records(body, sep).filter(F.trim("value") != "")
    numbered = number_rows(body.withColumns({"_all": F.lit(0), "_tie": F.lit(0)}), ["_all"], "line_no", "_tie", "row_seq", start=0)
    numbered = numbered.select("row_seq", _fields(sep).alias("r"))
    return numbered.select("row_seq", *[F.get("r", F.lit(i)).alias(c) for i, c in enumerate(header)])


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    encoding: str = "utf-8",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Delimited registry with a header, all columns as text, and `row_seq`, the row's number
    in file order; unknown headers are matched after folding accents and case."""
    df = _parsed(_lines(spark, path, encoding), sep, 0)
    if columns is None:
        return df
    found = {c: fuzzy_column(df.columns, c) for c in columns}
    missing = [c for c, f in found.items() if f is None]
    if missing:
        raise ValueError(f"{path}: columns not found: {missing}")
    return df.select("row_seq", *[F.col(f"`{f}`").alias(c) for c, f in found.items()])


def read_after_title(spark: SparkSession, path: str, skip: int, sep: str = ",", encoding: str = "utf-8") -> DataFrame:
    """Delimited file whose header follows `skip` title lines, blank lines among them."""
    return _parsed(_lines(spark, path, encoding), sep, skip)


def read_repaired(
    spark: SparkSession, path: str, replacements: Mapping[str, str], sep: str = ",", encoding: str = "utf-8"
) -> DataFrame:
    """Delimited text with known unquoted separators replaced before parsing."""

    def repair(text):
        for source, target in replacements.items():
            text = F.replace(text, F.lit(source), F.lit(target))
        return text

    return _parsed(_lines(spark, path, encoding), sep, 0, repair)


def least_garbled(spark: SparkSession, path: str, candidates: Sequence[str] = ("UTF-8", "ISO-8859-1")) -> str:
    """Encoding whose reading of the file has the fewest C1 control characters.

    All lines are read, in one aggregate; text that is not valid in an encoding rules it out.
    """
    raw = F.col("value").cast("binary")
    checks = []
    for i, name in enumerate(candidates):
        text = F.try_validate_utf8(raw.cast("string")) if name == "UTF-8" else F.decode(raw, name)
        checks += [
            F.count_if(text.isNull()).alias(f"bad{i}"),
            F.coalesce(F.sum(F.regexp_count(text, F.lit(r"[\x80-\x9F]"))), F.lit(0)).alias(f"c1{i}"),
        ]
    row = spark.read.text(path).agg(*checks).first()
    valid = [i for i in range(len(candidates)) if not row[f"bad{i}"]]
    return candidates[min(valid, key=lambda i: row[f"c1{i}"])] if valid else candidates[-1]


def column_by_values(df: DataFrame, allowed: Sequence[int]) -> str | None:
    """First column all of whose numbers belong to the allowed set (one aggregate for all)."""
    checks = []
    for i, name in enumerate(df.columns):
        number = F.col(f"`{name}`").cast("string").try_cast("double").try_cast("bigint")
        inside = F.when(number.isNotNull(), number.isin(*allowed))
        checks += [F.bool_and(inside).alias(f"ok{i}"), F.count(number).alias(f"n{i}")]
    row = df.agg(*checks).first()
    return next((c for i, c in enumerate(df.columns) if row[f"n{i}"] and row[f"ok{i}"]), None)


def read_matrix(spark: SparkSession, path: str, columns: Sequence[str] = ("iso", "cell_id", "mode", "level", "sector", "time_to_nearest_min")) -> DataFrame:
    """Stored travel matrices, partitioned by iso, mode, level and sector; only the named
    columns are scanned and partition filters prune folders. No folder means no rows."""
    from access_spark.sources.tables import read_or_empty

    types = {"cell_id": "bigint", "time_to_nearest_min": "float"}
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in columns)
    return read_or_empty(spark, path, schema).select(*columns)

"""Table maintenance, readers and keyed operators."""

from __future__ import annotations

import csv
import io
import json
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from access_spark import config
from access_spark.operators import keyed, linkage, marts, settlements, spatial, travel
from access_spark.plans import registries
from access_spark.sources import geojson, readers, tables


def cube_rows(spark, *rows):
    """(iso, value) pairs as full cube rows."""
    df = spark.createDataFrame(rows, "isoalpha3 string, value double")
    rest = {c: F.lit(1) if c in ("year",) else F.lit(1.0) if c == "population_base" else F.lit("x") for c in config.CUBE_COLUMNS if c not in ("isoalpha3", "value")}
    return df.withColumns(rest).select(*config.CUBE_COLUMNS)


def test_cube_writer(spark, tmp_path):
    path = str(tmp_path / "cube")
    assert tables.read_cube(spark, path).count() == 0 and tables.read_cube(spark, path).columns == list(config.CUBE_COLUMNS)
    assert tables.write_cube(cube_rows(spark, ("ARG", 1.0)), path)
    assert tables.write_cube(cube_rows(spark, ("BRA", 2.0)), path)
    for _ in range(3):
        assert tables.write_cube(cube_rows(spark, ("ARG", 5.0)), path)
    assert values(tables.read_cube(spark, path), "isoalpha3", "value") == [("ARG", 5.0), ("BRA", 2.0)]
    assert not tables.write_cube(cube_rows(spark, ("ARG", 9.0)).limit(0), path)
    with pytest.raises(keyed.DuplicateKeyError):
        tables.write_cube(cube_rows(spark, ("PER", 1.0), ("PER", 2.0)), path)
    assert values(tables.read_cube(spark, path), "isoalpha3", "value") == [("ARG", 5.0), ("BRA", 2.0)]
    assert values(tables.read_cube(spark, path, ["BRA", "PER"]), "isoalpha3", "value") == [("BRA", 2.0)]


def test_cube_writes_only_what_changed(spark, tmp_path):
    """Files of other countries stay; a reader that began before a swap sees the old rows."""
    path = tmp_path / "cube"
    tables.write_cube(cube_rows(spark, ("ARG", 1.0), ("BRA", 2.0)), str(path))
    files = {f: f.stat().st_mtime_ns for f in (path / "data").rglob("*.parquet")}
    before = tables.read_cube(spark, str(path))
    tables.write_cube(cube_rows(spark, ("ARG", 7.0)), str(path))
    assert {f: f.stat().st_mtime_ns for f in files} == files
    added = set((path / "data").rglob("*.parquet")) - set(files)
    assert added and all("isoalpha3=ARG" in str(f) for f in added)
    assert values(before, "isoalpha3", "value") == [("ARG", 1.0), ("BRA", 2.0)]
    assert values(tables.read_cube(spark, str(path)), "isoalpha3", "value") == [("ARG", 7.0), ("BRA", 2.0)]
    tables.write_cube(cube_rows(spark, ("ARG", 8.0)), str(path))
    assert tables.vacuum_cube(spark, str(path), keep=1) == 2
    assert values(tables.read_cube(spark, str(path)), "isoalpha3", "value") == [("ARG", 8.0), ("BRA", 2.0)]


def test_cube_writers_that_meet(spark, tmp_path, monkeypatch):
    """A number that another writer took is not overwritten; both changes are kept."""
    path = str(tmp_path / "cube")
    tables.write_cube(cube_rows(spark, ("ARG", 1.0)), path)
    add, raced = tables._add_manifest, []

    def late(spark, path, number, versions):
        if not raced:
            raced.append(number)
            tables.write_cube(cube_rows(spark, ("BRA", 2.0)), path)
        return add(spark, path, number, versions)

    monkeypatch.setattr(tables, "_add_manifest", late)
    tables.write_cube(cube_rows(spark, ("PER", 3.0)), path)
    assert values(tables.read_cube(spark, path), "isoalpha3", "value") == [("ARG", 1.0), ("BRA", 2.0), ("PER", 3.0)]


def test_upsert_keeps_columns(spark):
    old = spark.createDataFrame([("A", 1), ("B", 2)], "iso string, n int")
    new = spark.createDataFrame([("B", 3, "x")], "iso string, n int, extra string")
    out = tables.upsert_partitions(old, new)
    assert out.columns == ["iso", "n", "extra"]
    assert values(out, "iso", "n", "extra") == [("A", 1, None), ("B", 3, "x")]


def test_missing_table_is_empty(spark, tmp_path):
    assert tables.read_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0
    assert readers.read_matrix(spark, str(tmp_path / "none")).count() == 0


def test_ledger_twice(spark):
    ledger = spark.createDataFrame([("T", "1", 1, "a"), ("T", "2", 1, "a"), ("U", "1", 1, "u")], "iso string, id_centro string, run_seq int, v string")
    run = spark.createDataFrame([("T", "1", 2, "b")], "iso string, id_centro string, run_seq int, v string")
    once = tables.merge_ledger(ledger, run)
    assert values(tables.merge_ledger(once, run), "iso", "id_centro", "v") == [("T", "1", "b"), ("T", "2", "a"), ("U", "1", "u")]


def test_year_and_id(spark):
    out = tables.with_year_and_id(spark.createDataFrame([("a",)], "id_centro string"), 2023)
    assert values(out, "id_centro", "year", "id_national") == [("a", 2023, "a")]
    assert tables.with_year_and_id(out, 1999).first()["year"] == 2023


def test_one_to_one(spark):
    """The plan itself fails on a repeated key, on either side; building it runs nothing."""
    twice = spark.createDataFrame([("a",), ("b",), ("a",)], "k string")
    once = twice.distinct().withColumn("v", F.lit(1))
    assert keyed.one_to_one_join(once, once.withColumnRenamed("v", "w"), ["k"], "test").count() == 2
    for left, right in ((twice, once), (once.drop("v"), twice.withColumn("v", F.lit(1)))):
        joined = keyed.one_to_one_join(left, right, ["k"], "test")
        with pytest.raises(Exception, match="duplicate keys"):
            joined.select("k").collect()


def test_school_context_refuses_repeated_flags(spark):
    schools = spark.createDataFrame([("T", "1", 0.004, 0.004), ("T", "2", 0.004, 0.004)], "iso string, id_centro string, lat double, lon double")
    cells = spark.createDataFrame([("T", 0, 0.004, 0.004)], "iso string, cell_id bigint, lat double, lon double")
    flags = spark.createDataFrame([("T", "1", True), ("T", "2", False)], "iso string, id_centro string, include_in_spatial_indicators boolean")
    assert linkage.school_context(schools, flags, cells, ["cell_id"], 8e-3).count() == 2
    with pytest.raises(Exception, match="school context"):
        linkage.school_context(schools, flags.union(flags), cells, ["cell_id"], 8e-3).collect()


def test_crosswalk_fails_on_missing(spark):
    df = spark.createDataFrame([("ARG",)], "iso string")
    codes = spark.createDataFrame([("BRA", "BR")], "iso string, code string")
    with pytest.raises(Exception, match="no code for"):
        tables.country_crosswalk(df, codes, "iso", "code").collect()


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    tables.export_mart(df, str(tmp_path), "m")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv" / "m")).count() == 1
    assert json.loads(tables.bundle({"m": df}).first()["record"]) == {"k": "a", "n": 1}


# ---- readers --------------------------------------------------------------------------


def test_delimited(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("Código;Región;Otro\n1;Ñuble;x\n2;Maule;y\n".encode("latin-1"))
    df = readers.read_delimited(spark, str(path), sep=";", encoding="latin-1", columns=["codigo", "REGION"])
    assert values(df, "codigo", "REGION") == [("1", "Ñuble"), ("2", "Maule")]
    assert readers.least_garbled(spark, str(path)) == "ISO-8859-1"
    (tmp_path / "b.csv").write_text("Código\nÑuble\n", encoding="utf-8")
    assert readers.least_garbled(spark, str(tmp_path / "b.csv")) == "UTF-8"


def test_repaired_and_titled(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("id,place\n1,Bogotá, D.C.\n2,Cali\n", encoding="utf-8")
    df = readers.read_repaired(spark, str(path), {"Bogotá, D.C.": "Bogotá D.C."})
    assert values(df, "id", "place") == [("1", "Bogotá D.C."), ("2", "Cali")]
    path = tmp_path / "d.csv"
    path.write_text("Title\n\nid,v\n1,a\n", encoding="utf-8")
    assert values(readers.read_after_title(spark, str(path), 2), "id", "v") == [("1", "a")]


def test_rows_keep_their_place(spark, tmp_path):
    """Titles and headers go by position, equal data lines stay, numbers follow the file."""
    path = tmp_path / "e.csv"
    path.write_text("1,a\n\nid,v\n1,a\n\nid,v\n1,a\n2,b\n", encoding="utf-8")
    df = readers.read_after_title(spark, str(path), 2)
    assert values(df, "row_seq", "id", "v") == [(0, "1", "a"), (1, "id", "v"), (2, "1", "a"), (3, "2", "b")]
    path.write_text('id,v\n1,"two\nlines, ""x"""\n2,b\n2,b\n', encoding="utf-8")
    df = readers.read_repaired(spark, str(path), {})
    assert values(df, "row_seq", "id", "v") == [(0, "1", 'two\nlines, "x"'), (1, "2", "b"), (2, "2", "b")]
    path.write_text("", encoding="utf-8")
    assert readers.read_repaired(spark, str(path), {}).columns == ["row_seq"]


def test_many_splits_and_late_bytes(spark, tmp_path):
    path = tmp_path / "f.csv"
    lines = ["id;v"] + [f"{i};{'x' * (i % 50)}" for i in range(4000)]
    path.write_bytes(("\n".join(lines) + "\nlast;ñ\n").encode("latin-1"))
    assert readers.least_garbled(spark, str(path)) == "ISO-8859-1"
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        rows = readers.read_delimited(spark, str(path), sep=";", encoding="latin-1").orderBy("row_seq").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.id for r in rows] == [str(i) for i in range(4000)] + ["last"]
    assert [r.row_seq for r in rows] == list(range(4001)) and rows[-1].v == "ñ"


def _as_csv(text, sep):
    """Rows of the csv module, blank lines left out, filled and cut to the header; an empty
    field that is not quoted cannot be told there, so empty fields are ''."""
    rows = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=sep) if r]
    width = len(rows[0])
    return [tuple((r + [""] * width)[:width]) for r in rows[1:]]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("sep", [",", ";", "|", "\t"])
def test_quotes_read_as_the_csv_module(spark, tmp_path, small_splits, sep):
    """Only a quote that opens a field counts, also over lines and borders of splits."""
    rnd = random.Random(sep)
    parts = ["a", "é", '"', '""', sep, sep, "\n", "\n", 'b"c', f'{sep}"x', f'y"{sep}', f'{sep}"l\nm"{sep}']
    for n in range(3):
        body = "".join(rnd.choice(parts) for _ in range(700))
        if n % 2:  # close what is open now and then
            body = "\n".join(f'{i}{sep}{line}"\n"{i}{sep}tube 5" red{sep}"two\nlines ""{i}"""' for i, line in enumerate(body.split("\n")))
        text = f"p{sep}q{sep}r\n1{sep}tube 5\" red{sep}x\n" + body.rstrip("\n")
        path = tmp_path / f"q{n}.csv"
        path.write_text(text, encoding="utf-8", newline="")
        rows = readers.read_delimited(spark, str(path), sep=sep).orderBy("row_seq").collect()
        assert [r.row_seq for r in rows] == list(range(len(rows)))
        assert [(r.p or "", r.q or "", r.r or "") for r in rows] == _as_csv(text, sep)


def test_stray_quote_keeps_the_rows_after_it(spark, tmp_path):
    path = tmp_path / "stray.csv"
    path.write_text('id,v\n1,tube 5" red\n2,a\n3,"b ""c"""\n4,""\n5,\n', encoding="utf-8")
    assert values(readers.read_delimited(spark, str(path)), "id", "v") == [("1", 'tube 5" red'), ("2", "a"), ("3", 'b "c"'), ("4", ""), ("5", None)]


def test_features_are_cut_by_depth(spark, tmp_path, small_splits):
    """Braces and quotes in strings, nested objects, other members, any line breaks, many splits."""
    features = [
        {"type": "Feature", "properties": {"id_centro": str(i), "note": 'a } "b" { \\\\ \\" ' + "x" * (i % 40), "deep": {"a": {"b": [i, {"c": "}"}]}}},
         "geometry": {"type": "Point", "coordinates": [i + 0.5, -i]}}
        for i in range(200)
    ]
    for n, indent in enumerate((None, 2)):
        whole = {"type": "FeatureCollection", "name": "n", "crs": {"type": "name", "properties": {"name": "urn"}}, "features": features, "tail": {"x": 1}}
        if n:
            del whole["crs"], whole["tail"]
        path = tmp_path / f"f{n}.json"
        path.write_text(json.dumps(whole, indent=indent), encoding="utf-8")
        assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 4
        rows = geojson.read_geojson_points(spark, str(path)).orderBy("row_seq").collect()
        assert [(r.id_centro, r.longitud, r.latitud) for r in rows] == [(str(i), i + 0.5, float(-i)) for i in range(200)]
    assert geojson.read_geojson_points(spark, str(tmp_path)).count() == 400
    (tmp_path / "e.json").write_text('{"type": "FeatureCollection", "features": []}')
    assert geojson.read_geojson_points(spark, str(tmp_path / "e.json")).count() == 0


def test_rings_become_directed_edges(spark):
    square = [[0, 0], [0, 4], [4, 4], [4, 0], [0, 0]]  # clockwise in the file
    hole = [[1, 1], [2, 1], [2, 2], [1, 2]]  # counterclockwise and open
    rows = [(0, "Polygon", json.dumps([square, hole])), (1, "MultiPolygon", json.dumps([[hole], [square]])), (2, "Point", "[1, 2]"), (3, None, None)]
    out = geojson.ring_edges(spark.createDataFrame(rows, "row_seq long, kind string, coordinates string"))
    area = out.groupBy("row_seq", "part", "ring").agg(F.sum(F.expr("sx * ey - ex * sy") / 2).alias("a"), F.count(F.lit(1)).alias("n"))
    assert values(area, "row_seq", "part", "ring", "a", "n") == [(0, 0, 0, 16.0, 4), (0, 0, 1, -1.0, 4), (1, 0, 0, 1.0, 4), (1, 1, 0, 16.0, 4)]


def test_column_by_values(spark):
    df = spark.createDataFrame([("a", 1, "20232024"), ("b", 20222023, "20222023")], "x string, n int, y string")
    assert readers.column_by_values(df, (20222023, 20232024)) == "y"


def test_geojson(spark, tmp_path):
    path = tmp_path / "p.geojson"
    features = [
        {"type": "Feature", "properties": {"id_centro": "1", "latitud": 5.0, "longitud": 6.0}, "geometry": None},
        {"type": "Feature", "properties": {"id_centro": "2"}, "geometry": {"type": "Point", "coordinates": [7.0, 8.0]}},
        {"type": "Feature", "properties": {"id_centro": "3"}, "geometry": None},
    ]
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    assert values(geojson.read_geojson_points(spark, str(path)), "id_centro", "latitud", "longitud") == [("1", 5.0, 6.0), ("2", 8.0, 7.0)]


# ---- ordered operators -------------------------------------------------------------------


@pytest.mark.parametrize("repeat", [1, 50])
def test_running_total_with_hot_value(spark, repeat):
    # a third of the rows share one value
    rows = [("g", 7.0 if i % 3 == 0 else float(i % repeat), i, 1.0 + i % 5) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, v double, t int, w double")
    got = {r["t"]: (r["cum"], r["cum_total"]) for r in keyed.running_total(df, ["g"], "v", "t", F.col("w"), "cum", slices=8).collect()}
    total, expected = 0.0, {}
    for _, v, t, w in sorted(rows, key=lambda r: (r[1], r[2])):
        total += w
        expected[t] = total
    assert {k: v[0] for k, v in got.items()} == expected and {v[1] for v in got.values()} == {total}


@pytest.fixture
def any_order(spark):
    """Rows dealt anew at random each time they are read, as executors hand over a shuffle."""
    anywhere = F.udf(lambda _: random.SystemRandom().randrange(1 << 30), "int").asNondeterministic()
    spark.conf.set("spark.sql.exchange.reuse", "false")
    yield lambda df: df.withColumn("_at", anywhere(F.lit(0))).repartition(4, "_at").drop("_at")
    spark.conf.unset("spark.sql.exchange.reuse")


def test_numbers_whatever_order_rows_arrive_in(spark, any_order):
    rows = any_order(spark.range(0, 120000, 1, 4)).select(F.lit("g").alias("g"), "id")
    got = keyed.number_rows(rows, ["g"], "id", "id", "n", start=0).agg(F.count("n"), F.count_distinct("n"), F.count_if(F.col("n") != F.col("id"))).first()
    assert tuple(got) == (120000, 120000, 0)


def test_file_rows_whatever_order_lines_arrive_in(spark, any_order):
    lines = any_order(spark.range(0, 120001, 1, 4)).select(F.col("id").alias("line_no"), F.when(F.col("id") == 0, "h").otherwise(F.col("id").cast("string")).alias("value"))
    rows = readers._parsed(lines, ",", 0)
    got = rows.agg(F.count("h"), F.count_distinct("row_seq"), F.count_if(F.col("row_seq") + 1 != F.col("h").cast("bigint"))).first()
    assert tuple(got) == (120000, 120000, 0)


def test_numbered_schools_whatever_order_rows_arrive_in(spark, any_order):
    named = {"School type": "Openbaar", "Education level": "Primary", "School name": "A", "School code": "", "Latitude": "5 30 0 N", "Longitude": "55 15 0 W"}
    rows = any_order(spark.range(0, 120000, 1, 4)).select(F.col("id").alias("row_seq"), *[F.lit(v).alias(k) for k, v in named.items()])
    out = registries.standardize(registries.RULES["SUR"], {"main": rows})
    number = F.regexp_extract("id_centro", r"^SUR_NOID_(\d{3,})$", 1).cast("bigint")
    got = out.agg(F.count("id_centro"), F.count_distinct("id_centro"), F.count_if(number != F.col("row_seq") + 1)).first()
    assert tuple(got) == (120000, 120000, 0)


def test_coverage_of_building_paths(spark):
    schools = spark.createDataFrame(
        [("T", "1.0", 1, 1.0, 1.0), ("T", "2", 2, 2.0, 2.0), ("T", "3", 3, 3.0, 3.0), ("T", "4", 4, 4.0, 4.0), ("T", "5", 5, None, None)],
        "adm0_pcode string, id_centro string, row_seq bigint, latitud double, longitud double",
    )
    total = spark.createDataFrame([("T", "1", 1, "E1")], "adm0_pcode string, id_centro string, row_seq bigint, id_edificio string")
    regional = spark.createDataFrame(
        [("T", "2", 1, 9.0, 9.0, "E2"), ("T", "x", 2, 3.0, 3.0, "E3"), ("T", "y", 3, 4.0, 4.0, "E4"), ("T", "z", 4, 4.0, 4.0, "E5")],
        "adm0_pcode string, id_centro string, row_seq bigint, latitud double, longitud double, id_edificio string",
    )
    got = values(linkage.building_ids(schools, total, regional), "id_centro", "id_edificio", "match_path")
    assert got == [
        ("1.0", "E1", "A_total"), ("2", "E2", "B_lac_id"), ("3", "E3", "C_lac_coords"), ("4", "T_SYN_00001", "D_synthetic"), ("5", "T_SYN_00002", "D_synthetic"),
    ]


# ---- geometry and travel --------------------------------------------------------------------


def test_polygon_with_hole(spark):
    def ring(points):
        return [(1, "T", "P", *map(float, a), *map(float, b)) for a, b in zip(points, points[1:] + points[:1])]

    edges = spark.createDataFrame(
        ring([(0, 0), (9, 0), (9, 9), (0, 9)]) + ring([(3, 3), (3, 6), (6, 6), (6, 3)]),
        "level int, adm0_pcode string, pcode string, sx double, sy double, ex double, ey double",
    )
    points = spark.createDataFrame(
        [("in", "T", 1.0, 1.0), ("hole", "T", 4.5, 4.5), ("out", "T", 9.5, 1.0), ("edge", "T", 0.0, 4.0), ("corner", "T", 9.0, 9.0), ("level", "T", 7.0, 3.0)],
        "k string, adm0_pcode string, x double, y double",
    )
    got = {r["k"]: (r["inside"], r["on_edge"]) for r in spatial.polygons_of_points(points, edges, ["k"], 1.0).collect()}
    assert got == {"in": (True, False), "edge": (False, True), "corner": (False, True), "level": (True, False)}


def test_nearest_against_brute_force(spark):
    import random

    random.seed(3)
    # a third of the targets crowd one spot, some share a point
    targets = [(i, 0.5 + random.random() * 1e-4, 0.5 + random.random() * 1e-4) if i % 3 == 0 else (i, random.random(), random.random()) for i in range(600)]
    targets += [(1000 + i, 0.25, 0.75) for i in range(40)]
    queries = [(i, random.random(), random.random()) for i in range(60)]
    q = spark.createDataFrame([("g", *r) for r in queries], "g string, q int, x double, y double")
    t = spark.createDataFrame([("g", *r) for r in targets], "g string, seq int, tx double, ty double")
    got = {}
    for r in spatial.k_nearest_points(q, t, 5, "g", "q", [], "seq").collect():
        got.setdefault(r["q"], []).append((r["rank"], r["seq"]))
    for i, x, y in queries:
        best = sorted(targets, key=lambda r: ((r[1] - x) ** 2 + (r[2] - y) ** 2, r[0]))[:5]
        assert [s for _, s in sorted(got[i])] == [b[0] for b in best]


def test_settlements_against_flood_fill(spark):
    import random

    random.seed(5)
    cells = {(r, c) for r in range(30) for c in range(30) if random.random() < 0.42}
    cells |= {(0, c) for c in range(30)} | {(r, 29) for r in range(30)}  # one long component
    df = spark.createDataFrame([("T", r, c) for r, c in cells], "iso string, row bigint, col bigint")
    got = {(r["row"], r["col"]): r["component"] for r in settlements.dense_components(df).collect()}
    seen = {}
    for start in sorted(cells):
        if start in seen:
            continue
        stack = [start]
        while stack:
            cell = stack.pop()
            if cell in seen or cell not in cells:
                continue
            seen[cell] = start
            stack += [(cell[0] + a, cell[1] + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    groups = {}
    for cell, root in seen.items():
        groups.setdefault(root, set()).add(got[cell])
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_settlements_across_tiles(spark):
    side = 2 * settlements.TILE
    snake = {(r, c) for r in range(-20, 21, 4) for c in range(-3, side)}  # through three columns of tiles
    snake |= {(r + d, side - 1 if i % 2 else -3) for i, r in enumerate(range(-20, 20, 4)) for d in (1, 2, 3)}
    corner = {(side - 1, side - 1), (side, side)}  # two tiles that meet in a corner
    other = {(side - 1, side + 1), (side - 2, side + 2), (100, 7), (102, 7)}
    rows = [("T", r, c) for r, c in snake | corner | other] + [("U", 5, 5), ("U", None, 3)]
    df = spark.createDataFrame(rows, "iso string, row bigint, col bigint")
    got = {(r["iso"], r["row"], r["col"]): r["component"] for r in settlements.dense_components(df).collect()}
    number = lambda r, c: r * settlements.WIDE + c
    want = {("T", *cell): number(-20, -3) for cell in snake}
    want |= {("T", *cell): number(side - 2, side + 2) for cell in corner | {(side - 1, side + 1), (side - 2, side + 2)}}
    want |= {("T", 100, 7): number(100, 7), ("T", 102, 7): number(102, 7), ("U", 5, 5): number(5, 5)}
    assert got == want
    assert settlements.dense_components(df.limit(0)).count() == 0


def test_least_cost_uniform(spark):
    cells = spark.createDataFrame([("T", r, c, 0.01) for r in range(7) for c in range(7)], "iso string, row bigint, col bigint, value double")
    source = spark.createDataFrame([("T", 3, 3)], "iso string, row bigint, col bigint")
    widths = spark.createDataFrame([("T", 100.0)], "iso string, width_m double")
    got = {(r["row"], r["col"]): r["minutes"] for r in travel.least_cost_minutes(cells, source, 100.0, widths).collect()}
    for (r, c), minutes in got.items():
        a, b = abs(r - 3), abs(c - 3)
        assert abs(minutes - (min(a, b) * 2**0.5 + abs(a - b))) < 1e-9
    assert len(got) == 49


def _least_cost_by_hand(cells, sources, height, width):
    """Relax all steps until nothing changes."""
    best = {c: 0.0 for c in sources if c in cells}
    changed = True
    while changed:
        changed = False
        for (r, c), f in cells.items():
            for dr in (-1, 0, 1):
                for dc in (-1, 0, 1):
                    other = (r + dr, c + dc)
                    if (dr, dc) != (0, 0) and other in best and other in cells:
                        length = (abs(dr) * height * height + abs(dc) * width * width) ** 0.5
                        cost = best[other] + length * (f + cells[other]) / 2
                        if cost < best.get((r, c), float("inf")) - 1e-12:
                            best[(r, c)], changed = cost, True
    return best


def _least_cost(spark, cells, sources, tile):
    friction = spark.createDataFrame([("T", r, c, f) for (r, c), f in cells.items()], "iso string, row bigint, col bigint, value double")
    starts = spark.createDataFrame([("T", r, c) for r, c in sources], "iso string, row bigint, col bigint")
    widths = spark.createDataFrame([("T", 90.0)], "iso string, width_m double")
    out = travel.least_cost_minutes(friction, starts, 100.0, widths, tile=tile)
    return {(r["row"], r["col"]): r["minutes"] for r in out.collect()}


@pytest.mark.parametrize("tile", [4, 7, 128])
def test_least_cost_over_tiles(spark, tile):
    """Walls, high friction, negative rows and columns, a cell out of reach, a source on no cell."""
    cells = {(r, c): 0.001 * (1 + (r * 31 + c * 17) % 9) for r in range(-6, 12) for c in range(-5, 14) if (r * 7 + c * 5) % 11}
    cells[(40, 40)] = 0.001
    sources = [(-6, -5), (3, 3), (11, 13), (99, 99)]
    got, expected = _least_cost(spark, cells, sources, tile), _least_cost_by_hand(cells, sources, 100.0, 90.0)
    assert got.keys() == expected.keys() and (40, 40) not in got
    assert all(abs(got[c] - m) < 1e-9 for c, m in expected.items())


def test_least_cost_on_a_snake_needs_rounds_by_tiles(spark, monkeypatch):
    """A passage one cell wide that winds through all tiles: rounds follow borders, not cells."""
    path = [(r, c) for r in range(0, 40, 2) for c in (range(41) if r % 4 == 0 else range(40, -1, -1))]
    path += [(r, 40 if r % 4 == 1 else 0) for r in range(1, 38, 2)]
    cells = {c: 0.002 for c in path}
    rounds = []
    cut = travel.cut_lineage
    monkeypatch.setattr(travel, "cut_lineage", lambda df: rounds.append(1) or cut(df))
    got = _least_cost(spark, cells, [(0, 0)], 64)
    assert len(got) == len(cells) > 800 and len(rounds) <= 3
    rounds.clear()
    assert _least_cost(spark, cells, [(0, 0)], 21) == pytest.approx(got)
    assert len(rounds) < 60


def test_cube_ignores_absent_sector_and_null_keys(spark):
    from access_spark.operators import cube

    grid = spark.createDataFrame(
        [("T", 1, "urbana", "A", "A1", 10.0, 10.0, 10.0, 0.2, 1.0), ("T", 2, "dispersa", None, None, 30.0, 30.0, 30.0, None, 2.0)],
        "iso string, cell_id bigint, area_class string, adm1_pcode string, adm2_pcode string, pop_5_9 double, pop_10_14 double, pop_15_19 double, poverty_rate double, rwi double",
    )
    matrix = spark.createDataFrame([("T", 1, "walking", "primaria", "public", 20.0), ("T", 2, "walking", "primaria", "public", float("nan"))], "iso string, cell_id bigint, mode string, level string, sector string, minutes double")
    names = spark.createDataFrame([("A", "Alpha", "A1", "One")], "adm1_pcode string, adm1_name string, adm2_pcode string, adm2_name string")
    out = cube.indicator_cube(cube.prepare_grid(grid), matrix, names, "m", "s")
    assert {r["sector"] for r in out.select("sector").distinct().collect()} == {"Total", "Public"}
    country = out.filter("idgeo = 'country' AND sector = 'Total' AND area = 'Total' AND quintile = 'Total'")
    assert values(country, "time_band", "value", "population_base") == [("le15", 0.0, 40.0), ("le30", 25.0, 40.0), ("le60", 25.0, 40.0)]
    assert values(out.filter("idgeo = 'admin1' AND quintile = 'Total' AND area = 'Total' AND time_band = 'le30' AND sector = 'Total'"), "admin1_name", "value") == [("Alpha", 100.0)]
    assert out.select(*config.CUBE_KEY).distinct().count() == out.count()
    assert tuple(out.columns) == config.CUBE_COLUMNS


def test_unknown_area_stops(spark):
    from access_spark.operators.cube import area_label

    df = spark.createDataFrame([("selva",)], "a string")
    with pytest.raises(Exception, match="unmapped area_class"):
        df.select(area_label(F.col("a"))).collect()


# ---- registries and marts --------------------------------------------------------------------


def test_dom_prior_year(spark):
    rows = [
        (1, "02334 - HERNANDO GORJON", "PUBLICO", "PRIMARIO", "18033415,-", "-71,0", "20232024"), (2, "02334 - HERNANDO GORJON", "PUBLICO", "PRIMARIO", "19.8321,", ",1-71.01", "20222023"),
        (3, "1 - OTHER", "PRIVADO", "SECUNDARIO", "18.5", "70.1", "20232024"),
    ]
    raw = spark.createDataFrame(rows, "row_seq bigint, Centros string, Sector string, Nivel string, `Coordenadas Latitud` string, `Coordenadas Longitud` string, `Año` string")
    out = registries.standardize(registries.RULES["DOM"], {"main": raw})
    assert values(out, "id_centro", "sector", "latitud", "longitud", "nivel_secalta") == [("02334", "Public", 19.8321, -71.01, 0), ("1", "Private", 18.5, -70.1, 1)]


def test_cri_numbers_only_rows_that_stay_and_collapses_written_codes(spark):
    raw = spark.createDataFrame(
        [(1, "0", "A", "PRI", None, "Colegios"), (2, "0", "B", "PRI", "1", "Colegios"), (3, "0077", "C", "PUB", "1", "Colegios"), (4, "77", "D", "PUB", "1", "Colegios")],
        "row_seq bigint, `CODIGO PRESUP` string, NOMBRE string, DEPENDENCIA string, CIRCUITO string, sheet string",
    )
    points = spark.createDataFrame([], "row_seq bigint, CODPRES string, LATITUD string, LONGITUD string")
    out = registries.standardize(registries.RULES["CRI"], {"main": raw, "points": points})
    assert values(out, "id_centro", "nombre_centro") == [("77", "C"), ("77", "D"), ("CR_PRI_00000", "B")]


def test_ledger_ties_go_to_the_run(spark):
    old = spark.createDataFrame([("A", "1", 5, "old")], "iso string, id_centro string, run_seq int, v string")
    new = spark.createDataFrame([("A", "1", 5, "new")], "iso string, id_centro string, run_seq int, v string")
    assert values(tables.merge_ledger(old, new), "v") == [("new",)]
    assert values(tables.merge_ledger(new, old), "v") == [("old",)]


def test_failed_rename_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.publish(spark.range(3), path)
    real = tables._fs

    class Refuses:
        def __init__(self, fs):
            self.fs = fs

        def rename(self, source, target):
            return False if "staging" in str(source) else self.fs.rename(source, target)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    monkeypatch.setattr(tables, "_fs", lambda s, p: (Refuses(real(s, p)[0]), real(s, p)[1]))
    with pytest.raises(OSError):
        tables.publish(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3


def test_nearest_passes_over_points_that_are_not_finite(spark):
    import random

    rnd = random.Random(2)
    nan, inf = float("nan"), float("inf")
    queries = [("g", i, rnd.random(), rnd.random()) for i in range(300)]
    targets = [("g", i, rnd.random(), rnd.random()) for i in range(300)]
    bad = [("g", 900, nan, 0.5), ("g", 901, 0.5, inf), ("g", 902, -inf, nan)]
    q = spark.createDataFrame(queries + bad + [("g", 903, None, 0.1)], "grp string, q int, x double, y double")
    t = spark.createDataFrame(targets + bad, "grp string, seq int, tx double, ty double")
    got = {r.q: (r.seq, r.d2) for r in spatial.k_nearest_points(q, t, 1, "grp", "q", [], "seq").collect()}
    assert set(got) == {i for _, i, _, _ in queries}
    for _, i, x, y in queries:
        d2, seq = min(((x - tx) ** 2 + (y - ty) ** 2, s) for _, s, tx, ty in targets)
        assert got[i][0] == seq and abs(got[i][1] - d2) < 1e-12


def test_cri_and_slv(spark):
    raw = spark.createDataFrame(
        [(1, "0", "A", "PRI", "1", "Colegios"), (2, "0", "B", "SUB", "1", "Colegios"), (3, "77.0", "C", "PUB", "1", "I y II Ciclos"), (4, "9", "D", "PUB", None, "Colegios")],
        "row_seq bigint, `CODIGO PRESUP` string, NOMBRE string, DEPENDENCIA string, CIRCUITO string, sheet string",
    )
    points = spark.createDataFrame([(1, "77", "9.9", "-84.1")], "row_seq bigint, CODPRES string, LATITUD string, LONGITUD string")
    out = registries.standardize(registries.RULES["CRI"], {"main": raw, "points": points})
    assert values(out, "id_centro", "sector", "latitud") == [("77", "Public", 9.9), ("CR_PRI_00000", "Private", None), ("CR_PRI_00001", "Private", None)]
    census = spark.createDataFrame([(1, "10", "x", "5", None), (2, "11", "y", None, "3")], "row_seq bigint, CODIGO string, NOMBRE string, `1` string, `1A` string")
    listed = spark.createDataFrame([(1, "10", "Privado", "x", None), (2, "99", "Privado", "z", "13.5, -89.2")], "row_seq bigint, CODIGO string, SECTOR string, NOMBRE string, COORDENADAS string")
    out = registries.standardize(registries.RULES["SLV"], {"main": census, "points": listed})
    assert values(out, "id_centro", "sector", "nivel_primaria", "nivel_secalta", "latitud") == [("10", "Private", 1, 0, None), ("11", "Public", 0, 1, None), ("99", "Private", 1, 0, 13.5)]


def test_quality_totals_remainder(spark):
    labels = ", ".join(f"q_{q} int" for q in config.QUALITY_LABELS)
    country = spark.createDataFrame([("T", True, False, 10, *([1] * 8 + [0] * 3))], f"iso string, pipeline_enabled boolean, analysis_included boolean, current_total int, {labels}")
    out = marts.quality_totals(country).filter("quality = 'unclassified'")
    assert values(out, "scope", "count", "pct_of_total") == [("pipeline", 2, 20.0)]


def test_contracts():
    assert len(config.BASE_COLUMNS) == 9 and len(config.ENRICHED_COLUMNS) == len(set(config.ENRICHED_COLUMNS))
    assert len(config.CUBE_COLUMNS) == 19 and len(config.CUBE_KEY) == 12 and len(config.LEDGER_COLUMNS) == 24
    assert set(config.COUNTRIES) == set(config.COUNTRY_BOXES) == set(registries.RULES) and len(config.COUNTRIES) == 23
    assert len(config.QUALITY_LABELS) == 11 and set(config.MATCH_LEVELS) == {"adm2", "adm1", "spatial_only", "bbox_only"}

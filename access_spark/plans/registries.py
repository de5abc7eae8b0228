"""National registries in one schema: one declarative rule per country, one job for all.

A raw table is staged with its published headers and `row_seq`, the order of its rows. A
rule names the columns it needs, the rows it keeps, and one expression each for the levels,
the sector, the id, the name and the point. Everything else is shared.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_spark import config
from access_spark.functions.geo import dms_to_degrees, last_number, mercator_to_degrees, split_pair, utm_to_degrees, within
from access_spark.functions.numeric import any_nonzero, any_positive, comma_number, flag, number
from access_spark.functions.text import any_of, extract, integer_id, normalize_id, numbered_id
from access_spark.operators import linkage
from access_spark.operators.keyed import keep_first, number_rows, union_columns
from access_spark.plans.finalize import conform
from access_spark.sources.readers import column_by_values

Frames = Mapping[str, DataFrame]
Expr = Callable[[], Column]


def c(name: str) -> Column:
    return F.col(name)


def text(name: str) -> Column:
    """Trimmed text of a column, '' when missing."""
    return F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))


def upper(name: str) -> Column:
    return F.upper(text(name))


def yes() -> Column:
    return F.lit(True)


def no() -> Column:
    return F.lit(False)


def is_true(name: str) -> Column:
    return number(c(name)) == 1


@dataclass(frozen=True)
class Rule:
    """How one country's raw table becomes registry rows.

    `columns` maps a working name to header tokens, tried in order: '=x' asks for the exact
    header, 'a&b' for a header with both parts. A column that no header fits is null.
    """

    iso: str
    columns: Mapping[str, Sequence[str]]
    primary: Expr
    lower: Expr
    upper: Expr
    private: Expr = no
    unknown: Expr = no
    keep: Expr = yes
    id: Expr = field(default=lambda: text("id"))
    name: Expr = field(default=lambda: text("name"))
    lat: Expr = field(default=lambda: number(c("lat")))
    lon: Expr = field(default=lambda: number(c("lon")))
    collapse: str | None = None  # 'first' row per id, or 'school': merge the rows of an id
    merge_all: bool = False  # rows without a level still give a school its name and point
    before: Callable[[DataFrame, Frames], DataFrame] | None = None  # joins on the raw rows
    kept: Callable[[DataFrame, Frames], DataFrame] | None = None  # changes to the rows that `keep` leaves
    after: Callable[[DataFrame, Frames], DataFrame] | None = None  # joins on registry rows


def fold_header(header: str) -> str:
    plain = unicodedata.normalize("NFKD", header.replace("﻿", "")).encode("ascii", "ignore").decode("ascii")
    return " ".join(plain.lower().replace("_", " ").split())


def find_column(headers: Sequence[str], tokens: Sequence[str]) -> str | None:
    folded = [(h, fold_header(h)) for h in headers]
    for token in tokens:
        exact = token.startswith("=")
        parts = [fold_header(p) for p in token.lstrip("=").split("&")]
        for header, plain in folded:
            if (plain == parts[0]) if exact else all(p in plain for p in parts):
                return header
    return None


def working_columns(raw: DataFrame, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Only the named columns under their working names, so the scan reads nothing else."""
    found = {name: find_column(raw.columns, tokens) for name, tokens in columns.items()}
    picked = [
        (F.col(f"`{header}`") if header else F.lit(None).cast("string")).alias(name) for name, header in found.items()
    ]
    return raw.select(*picked, "row_seq")


def standardize(rule: Rule, frames: Frames) -> DataFrame:
    """Registry rows of one country in the base schema, with row_seq."""
    rows = working_columns(frames["main"], rule.columns)
    if rule.before:
        rows = rule.before(rows, frames)
    rows = rows.filter(F.coalesce(rule.keep(), F.lit(False)))
    if rule.kept:
        rows = rule.kept(rows, frames)
    sector = F.when(F.coalesce(rule.unknown(), F.lit(False)), "Unknown").when(
        F.coalesce(rule.private(), F.lit(False)), "Private"
    ).otherwise("Public")
    out = rows.select(
        "row_seq", rule.id().alias("id_centro"), rule.name().alias("nombre_centro"), sector.alias("sector"),
        flag(rule.primary()).alias("nivel_primaria"), flag(rule.lower()).alias("nivel_secbaja"), flag(rule.upper()).alias("nivel_secalta"),
        rule.lat().alias("latitud"), rule.lon().alias("longitud"),
    )
    if not rule.merge_all:
        out = linkage.k12(out)
    if rule.collapse == "school":
        out = out.withColumn("nombre_centro", F.nullif("nombre_centro", F.lit("")))
        seq = out.groupBy("id_centro").agg(F.min("row_seq").alias("row_seq"))
        out = linkage.collapse_schools(out.filter("id_centro IS NOT NULL")).join(seq, "id_centro")
    if rule.merge_all:
        out = linkage.k12(out)
    if rule.after:
        out = rule.after(out, frames)
    if rule.collapse == "first":
        out = keep_first(out, ["id_centro"], F.col("row_seq"))
    return conform(out.withColumn("adm0_pcode", F.lit(rule.iso)), {**config.BASE_COLUMNS, "row_seq": "bigint"})


def standardize_all(raws: Mapping[str, Frames]) -> DataFrame:
    """All countries in one table; each is an independent branch of the same job."""
    return union_columns(*[standardize(RULES[iso], frames) for iso, frames in raws.items()])


# ---- joins some countries need ---------------------------------------------------------------


def _attach_points(key: Callable[[Column], Column], columns: Mapping[str, Sequence[str]], lat: Expr, lon: Expr):
    """Coordinates from a second table, the first row per id."""

    def join(rows: DataFrame, frames: Frames) -> DataFrame:
        points = working_columns(frames["points"], columns)
        points = points.select(key(c("id")).alias("_k"), lat().alias("_lat"), lon().alias("_lon"), "row_seq")
        points = keep_first(points, ["_k"], F.col("row_seq")).drop("row_seq")
        out = rows.withColumn("_k", key(c("id_centro")))
        return out.join(points, "_k", "left").withColumns({"latitud": c("_lat"), "longitud": c("_lon")}).drop("_k", "_lat", "_lon")

    return join


def _cri_points(*points):
    """Coordinates by the id as a whole number, which is also the id that is published."""

    def join(rows: DataFrame, frames: Frames) -> DataFrame:
        return _attach_points(*points)(rows, frames).withColumn("id_centro", integer_id(c("id_centro")))

    return join


def _bra_points(rows: DataFrame, frames: Frames) -> DataFrame:
    sources = [frames[n].select("id_centro", "latitud", "longitud", "row_seq") for n in ("survey", "connected", "geojson") if n in frames]
    return linkage.coordinate_cascade(rows, sources).drop("coord_source_rank")


def _chl_admission(rows: DataFrame, frames: Frames) -> DataFrame:
    """Schools of the admission list with a school code, or fully private ones."""
    codes = (10, 110, 310, 410, 510, 610, 710, 810, 910)
    listed = working_columns(frames["admission"], {"rbd": ("=rbd",), "code": ("cod ense",)})
    wanted = listed.filter(number(c("code")).isin(*codes)).select(integer_id(c("rbd")).alias("_k")).distinct()
    # every column of education codes, however many there are
    main = frames["main"]
    held = [F.col(f"`{h}`").cast("string") for h in main.columns if fold_header(h).startswith("ens ")]
    codes_of = main.select("row_seq", (F.array(*held) if held else F.array().cast("array<string>")).alias("_ens"))
    rows = rows.join(codes_of, "row_seq")
    return rows.withColumn("_k", integer_id(c("id"))).join(wanted.withColumn("_listed", F.lit(True)), "_k", "left")


def _chl_codes(*codes: int) -> Column:
    return F.exists("_ens", lambda x: F.coalesce(number(x).isin(*codes), F.lit(False)))


def _col_services(rows: DataFrame, frames: Frames) -> DataFrame:
    services = working_columns(frames["services"], {"id": ("=sede codigo",), "level": ("nivel&ense",)})
    levels = linkage.levels_from_services(
        services.select(normalize_id(c("id")).alias("_k"), number(c("level")).cast("int").alias("level")), "_k", "level"
    )
    return rows.withColumn("_k", normalize_id(c("id"))).join(levels, "_k")


def _cri_ids(rows: DataFrame, frames: Frames) -> DataFrame:
    """Rows without a valid code get numbered ids per sector, in row order of the rows kept;
    codes stay as they are written."""
    bad = F.coalesce(c("id"), F.lit("")).isin("0", "0.0", "0000", "nan", "None", "")
    keyed = rows.withColumn("_kind", F.when(upper("dependency").isin("PRI", "SUB"), "PRI").otherwise("PUB"))
    numbered = number_rows(keyed.filter(bad).select("_kind", "row_seq"), ["_kind"], "row_seq", "row_seq", "_n", start=0)
    made = numbered.select("row_seq", F.format_string("CR_%s_%05d", c("_kind"), c("_n")).alias("_made"))
    return keyed.join(made, "row_seq", "left").withColumn("id", F.coalesce("_made", c("id").cast("string"))).drop("_made", "_kind")


def _dom_years(rows: DataFrame, frames: Frames) -> DataFrame:
    """This year's rows; where a point is outside the country, last year's first valid one."""
    year_column = column_by_values(frames["main"].drop("row_seq"), (20222023, 20232024))
    if year_column is None:
        return rows
    years = frames["main"].select("row_seq", number(F.col(f"`{year_column}`")).cast("bigint").alias("_year"))
    both = rows.join(years, "row_seq").withColumns(
        {"_id": extract(c("center"), r"^(\d+)"), "latitud": last_number(c("lat")), "longitud": last_number(c("lon"), True)}
    )
    now = both.filter("_year = 20232024").withColumn("longitud", within(c("longitud"), -75, -60))
    valid = c("latitud").between(17.0, 21.5) & c("longitud").between(-75.5, -68.0)
    prior = both.filter("_year = 20222023").select("_id", "latitud", "longitud", "row_seq")
    return linkage.prior_period_fallback(now, prior, valid, key="_id").withColumns(
        {"lat": c("latitud"), "lon": c("longitud")}
    ).drop("latitud", "longitud")


def _per_enrolment(rows: DataFrame, frames: Frames) -> DataFrame:
    grades = {f"d{i:02d}": (f"=D{i:02d}",) for i in range(1, 11)}
    counts = working_columns(frames["enrolment"], {"code": ("=COD MOD",), "kind": ("=NIV MOD",), **grades})
    flags = counts.filter("kind = 'F0'").groupBy(text("code").alias("_k")).agg(
        F.max(any_nonzero(*[c(f"d{i:02d}") for i in range(1, 5)])).alias("_low"),
        F.max(any_nonzero(*[c(f"d{i:02d}") for i in range(5, 11)])).alias("_high"),
    )
    return rows.withColumn("_k", text("code")).join(flags, "_k", "left")


def _pry_media(rows: DataFrame, frames: Frames) -> DataFrame:
    """Basic education rows followed by the rows of the upper secondary table."""
    columns = {"id": ("=codigo establecimiento",), "name": ("nombre institucion",), "sector": ("sector o tipo gestion",)}
    media = working_columns(frames["media"], columns).withColumns({"media": F.lit(1), "row_seq": c("row_seq") + F.lit(1 << 40)})
    return union_columns(rows.withColumn("media", F.lit(0)), media)


def _slv_private(rows: DataFrame, frames: Frames) -> DataFrame:
    """Sector from the coordinate list; its private schools that the census lacks are added."""
    columns = {"id": ("codigo",), "sector": ("sector",), "name": ("nombre",), "pair": ("coordenadas",)}
    listed = working_columns(frames["points"], columns).withColumn("id_centro", text("id"))
    private = c("sector_raw").contains("rivado")
    known = keep_first(listed.select("id_centro", c("sector").alias("sector_raw"), "row_seq"), ["id_centro"], F.col("row_seq")).drop("row_seq")
    base = rows.join(known, "id_centro", "left").withColumn(
        "sector", F.when(F.coalesce(private, F.lit(False)), "Private").otherwise("Public")
    ).drop("sector_raw")
    lat, lon = split_pair(c("pair"))
    extra = listed.filter(c("sector").contains("rivado")).select(
        "id_centro", text("name").alias("nombre_centro"), F.lit("Private").alias("sector"), F.lit(1).alias("nivel_primaria"),
        F.lit(0).alias("nivel_secbaja"), F.lit(0).alias("nivel_secalta"), lat.alias("latitud"), lon.alias("longitud"),
        (c("row_seq") + F.lit(1 << 40)).alias("row_seq"),
    )
    return linkage.add_extra_rows(base, extra)


def _sur_ids(rows: DataFrame, frames: Frames) -> DataFrame:
    """Rows without a code are numbered in row order."""
    bad = F.coalesce(c("id"), F.lit("")).isin("nan", "None", "")
    lost = rows.filter(bad & text("edu").isin("Primary", "Secondary - Academic", "Secondary - Vocational", "Upper Secondary"))
    numbered = number_rows(lost.select(F.lit(0).alias("_g"), "row_seq"), ["_g"], "row_seq", "row_seq", "_n")
    made = numbered.select("row_seq", numbered_id("SUR_NOID_", c("_n"), 3).alias("_made"))
    return rows.join(made, "row_seq", "left").withColumn("id", F.coalesce("_made", "id")).drop("_made")


def _ury_layers(rows: DataFrame, frames: Frames) -> DataFrame:
    """Primary schools followed by general and technical secondary schools."""
    parts = [rows.withColumn("layer", F.lit("primary"))]
    for i, (name, columns) in enumerate(
        (
            ("secondary", {"id": ("ruee calcu",), "name": ("first nomb",), "x": ("=x",), "y": ("=y",)}),
            ("technical", {"id": ("=ruee",), "name": ("first desc",), "x": ("=x",), "y": ("=y",)}),
        ),
        start=1,
    ):
        if name in frames:
            layer = working_columns(frames[name], columns)
            parts.append(layer.withColumns({"layer": F.lit(name), "row_seq": c("row_seq") + F.lit(i << 40)}))
    return union_columns(*parts)


# ---- the rules ----------------------------------------------------------------------------------

RULES: dict[str, Rule] = {
    rule.iso: rule
    for rule in (
        Rule(
            "ARG",
            {
                "id": ("=cueanexo",), "name": ("=nombre", "=nombre est", "=nombre establecimiento"), "sector": ("=sector",), "common": ("=comun",),
                "prim": ("=comun primaria",), "cb": ("=comun cb",), "co": ("=comun co",), "both": ("=comun ambos",), "lat": ("=latitud",), "lon": ("=longitud",),
            },
            keep=lambda: number(c("sector")).isin(1, 2) & (c("common") == "X"),
            primary=lambda: c("prim") == "X",
            lower=lambda: (text("cb") == "X") | (text("both") == "X"),
            upper=lambda: (text("co") == "X") | (text("both") == "X"),
            private=lambda: number(c("sector")) == 2,
        ),
        Rule(
            "BHS",
            {"island": ("=island",), "kind": ("=type",), "owner": ("=ownership",), "name": ("=name",), "lat": ("=latitude",), "lon": ("=longitude",)},
            keep=lambda: F.lower(text("island")) != "virtual",
            primary=lambda: F.lower(text("kind")).isin("primary", "all age"),
            lower=lambda: F.lower(text("kind")).isin("secondary", "all age"),
            upper=lambda: F.lower(text("kind")).isin("secondary", "all age"),
            private=lambda: c("owner") == "Private",
            unknown=lambda: ~F.coalesce(c("owner").isin("Bahamas Government", "Private"), F.lit(False)),
            id=lambda: numbered_id("BHS-", c("row_seq"), 3),
        ),
        Rule(
            "BLZ",
            {"edu": ("level", "tipo", "educ"), "id": ("code", "id"), "name": ("name", "nombre"), "lat": ("lat",), "lon": ("lon", "lng")},
            primary=lambda: any_of(c("edu"), "Primary|Primaria"),
            lower=lambda: any_of(c("edu"), "Primary|Primaria"),
            upper=lambda: any_of(c("edu"), "Secondary|Secundaria"),
        ),
        Rule(
            "BOL",
            {
                "system": ("sub sist",), "dependency": ("depend",), "edu": ("nivel auto", "nivel"), "id": ("codigo", "rue"), "name": ("institucion", "nombre"),
                "lat": ("=cord x", "=latitud", "=lat"), "lon": ("=cord y", "=longitud", "=lon"),
            },
            keep=lambda: c("system") == "Regular",
            primary=lambda: any_of(c("edu"), "Primaria"),
            lower=lambda: any_of(c("edu"), "Secundaria"),
            upper=lambda: any_of(c("edu"), "Secundaria"),
            private=lambda: F.lower(text("dependency")) == "privada",
            lat=lambda: within(number(c("lat")), -23, 8),
            lon=lambda: within(number(c("lon")), -70, -57),
        ),
        Rule(
            "BRA",
            {
                "id": ("=co entidade",), "name": ("=no entidade",), "dependency": ("=tp dependencia",), "active": ("=tp situacao funcionamento",),
                "ai": ("=in fund ai",), "af": ("=in fund af",), "med": ("=in med",),
            },
            keep=lambda: is_true("active"),
            primary=lambda: is_true("ai"),
            lower=lambda: is_true("af"),
            upper=lambda: is_true("med"),
            private=lambda: number(c("dependency")) == 4,
            lat=lambda: F.lit(None).cast("double"),
            lon=lambda: F.lit(None).cast("double"),
            after=_bra_points,
        ),
        Rule(
            "BRB",
            {"edu": ("level", "tipo"), "id": ("code", "id"), "name": ("name", "nombre"), "lat": ("lat",), "lon": ("lon", "lng")},
            primary=lambda: any_of(c("edu"), "Primary|Primaria"),
            lower=lambda: any_of(c("edu"), "Secondary|Secundaria"),
            upper=lambda: any_of(c("edu"), "Secondary|Secundaria"),
        ),
        Rule(
            "CHL",
            {
                "id": ("=rbd",), "name": ("=nom rbd",), "dependency": ("=cod depe",), "lat": ("=latitud",), "lon": ("=longitud",),
            },
            before=_chl_admission,
            keep=lambda: F.coalesce(c("_listed"), F.lit(False)) | (number(c("dependency")) == 4),
            primary=lambda: _chl_codes(110),
            lower=lambda: _chl_codes(110),
            upper=lambda: _chl_codes(310, 410, 510, 610, 710, 810, 910),
            private=lambda: number(c("dependency")) == 4,
            lat=lambda: comma_number(c("lat")),
            lon=lambda: comma_number(c("lon")),
            collapse="school",
        ),
        Rule(
            "COL",
            {"id": ("=sede codigo",), "name": ("=sede nombre",), "state": ("=estado id",), "news": ("=novedad id",), "sector": ("=sector id",)},
            before=_col_services,
            keep=lambda: (number(c("state")) != 0) & (number(c("news")) == 9),
            primary=lambda: c("nivel_primaria") == 1,
            lower=lambda: c("nivel_secbaja") == 1,
            upper=lambda: c("nivel_secalta") == 1,
            private=lambda: number(c("sector")) == 2,
            unknown=lambda: ~F.coalesce(number(c("sector")).isin(1, 2), F.lit(False)),
            id=lambda: normalize_id(c("id")),
            lat=lambda: F.lit(None).cast("double"),
            lon=lambda: F.lit(None).cast("double"),
            after=_attach_points(
                normalize_id, {"id": ("sede", "codigo"), "lat": ("lat",), "lon": ("lon", "lng")}, lambda: number(c("lat")), lambda: number(c("lon"))
            ),
        ),
        Rule(
            "CRI",
            {"id": ("codigo", "presup"), "name": ("nombre", "institucion"), "dependency": ("depend",), "circuit": ("circuit",), "sheet": ("=sheet",)},
            keep=lambda: c("circuit").isNotNull(),
            kept=_cri_ids,
            primary=lambda: c("sheet") == "I y II Ciclos",
            lower=lambda: c("sheet") == "Colegios",
            upper=lambda: c("sheet") == "Colegios",
            private=lambda: upper("dependency").isin("PRI", "SUB"),
            lat=lambda: F.lit(None).cast("double"),
            lon=lambda: F.lit(None).cast("double"),
            collapse="school",
            after=_cri_points(
                integer_id, {"id": ("codpres", "cod pres", "id centro"), "lat": ("lat",), "lon": ("lon", "lng")}, lambda: number(c("lat")), lambda: number(c("lon"))
            ),
        ),
        Rule(
            "DOM",
            {"center": ("=centros",), "sector": ("=sector",), "edu": ("=nivel",), "lat": ("lat&coord",), "lon": ("lon&coord",)},
            before=_dom_years,
            primary=lambda: any_of(c("edu"), "PRIMARIO"),
            lower=lambda: any_of(c("edu"), "PRIMARIO"),
            upper=lambda: text("edu") == "SECUNDARIO",
            private=lambda: upper("sector") == "PRIVADO",
            id=lambda: extract(c("center"), r"^(\d+)"),
            name=lambda: extract(c("center"), r"-\s*(.*)$"),
            lat=lambda: c("lat").cast("double"),
            lon=lambda: c("lon").cast("double"),
            collapse="school",
        ),
        Rule(
            "ECU",
            {"id": ("amie",), "name": ("nombre inst", "nombre"), "kind": ("tipo educ",), "support": ("sostenimie",), "edu": ("nivel educ",)},
            keep=lambda: text("kind") == "Ordinaria",
            primary=lambda: any_of(c("edu"), "B[áa]sica|EGB"),
            lower=lambda: any_of(c("edu"), "B[áa]sica|EGB"),
            upper=lambda: any_of(c("edu"), "Bachillerato"),
            private=lambda: text("support") == "Particular",
            lat=lambda: F.lit(None).cast("double"),
            lon=lambda: F.lit(None).cast("double"),
            after=_attach_points(
                lambda col: col.cast("string"), {"id": ("amie",), "x": ("=easting", "=x"), "y": ("=northing", "=y")},
                lambda: utm_to_degrees(number(c("x")), number(c("y")), 17, True)[0], lambda: utm_to_degrees(number(c("x")), number(c("y")), 17, True)[1],
            ),
        ),
        Rule(
            "GTM",
            {"id": ("codigo",), "name": ("nombre",), "edu": ("nivel",), "sector": ("sector",), "state": ("situacion", "estado"), "lat": ("lat",), "lon": ("lon",)},
            keep=lambda: (upper("state") != "CERRADA DEFINITIVAMENTE") & ~upper("edu").contains("ADULTOS"),
            primary=lambda: upper("edu") == "PRIMARIA",
            lower=lambda: upper("edu").contains("BASICO"),
            upper=lambda: upper("edu").contains("DIVERSIFICADO"),
            private=lambda: upper("sector") == "PRIVADO",
            lat=lambda: F.nullif(number(c("lat")), F.lit(0.0)),
            lon=lambda: F.nullif(number(c("lon")), F.lit(0.0)),
            collapse="school",
        ),
        Rule(
            "GUY",
            {"kind": ("type", "level"), "id": ("=school id",), "name": ("=school name",), "lat": ("=latitude",), "lon": ("=longitude",)},
            primary=lambda: any_of(c("kind"), "P"),
            lower=lambda: F.upper(c("kind")).isin("S", "ST", "SEC"),
            upper=lambda: F.upper(c("kind")).isin("S", "ST", "SEC"),
            collapse="first",
        ),
        Rule(
            "HND",
            {"id": ("digo&centro", "digo"), "name": ("nombre&centro", "nombre", "plantel"), "edu": ("=nivel", "nivel"), "lat": ("=latitud", "=lat"), "lon": ("=longitud", "=lon")},
            keep=lambda: ~any_of(c("edu"), "Adultos"),
            primary=lambda: any_of(F.regexp_replace(text("edu"), r"Pre-?[Bb][áa]sica", "PREBAS"), "Básica|Basica|Primaria"),
            lower=lambda: any_of(F.regexp_replace(text("edu"), r"Pre-?[Bb][áa]sica", "PREBAS"), "Básica|Basica|Primaria"),
            upper=lambda: any_of(c("edu"), "Media"),
            collapse="first",
        ),
        Rule(
            "HTI",
            {"name": ("school", "name"), "lat": ("lat",), "lon": ("lon",)},
            primary=yes,
            lower=no,
            upper=no,
            id=lambda: c("row_seq").cast("string"),
        ),
        Rule(
            "MEX",
            {"id": ("id centro",), "name": ("nombre&centro",), "edu": ("=nivel",), "control": ("=control",), "lat": ("lat",), "lon": ("lon", "lng")},
            primary=lambda: F.upper(c("edu")) == "PRIMARIA",
            lower=lambda: F.upper(c("edu")) == "SECUNDARIA",
            upper=lambda: F.upper(c("edu")).isin("MEDIA SUPERIOR", "BACHILLERATO", "PREPARATORIA"),
            private=lambda: upper("control") == "PRIVADO",
            collapse="first",
        ),
        Rule(
            "PAN",
            {"id": ("siace", "codigo"), "name": ("nombre&centro",), "dependency": ("depend",), "frame": ("marco&sistem", "marco&subsist"), "offer": ("oferta",), "state": ("estatus", "status")},
            keep=lambda: upper("frame").contains("REGULAR") & (text("offer") != "NO ESPECIFICADO") & (text("state") != "IPHE"),
            primary=lambda: upper("offer").contains("PRIMARIA"),
            lower=lambda: upper("offer").contains("PREMEDIA"),
            upper=lambda: upper("offer").rlike(r"\bMEDIA\b"),
            private=lambda: upper("dependency") == "PARTICULAR",
            lat=lambda: F.lit(None).cast("double"),
            lon=lambda: F.lit(None).cast("double"),
            after=_attach_points(
                lambda col: F.trim(col.cast("string")), {"id": ("siace", "codigo"), "lat": ("lat",), "lon": ("lon", "lng")}, lambda: number(c("lat")), lambda: number(c("lon"))
            ),
        ),
        Rule(
            "PER",
            {
                "code": ("=COD MOD",), "annex": ("=ANEXO",), "name": ("=CEN EDU",), "kind": ("=NIV MOD",), "form": ("=D FORMA",), "owner": ("=GESTION",),
                "lat": ("=NLAT IE",), "lon": ("=NLONG IE",),
            },
            before=_per_enrolment,
            keep=lambda: c("kind").isin("B0", "F0") & (c("form") == "Escolarizada"),
            primary=lambda: c("kind") == "B0",
            lower=lambda: c("_low") == 1,
            upper=lambda: c("_high") == 1,
            private=lambda: number(c("owner")) == 3,
            id=lambda: F.concat_ws("-", text("code"), text("annex")),
            lat=lambda: comma_number(c("lat")),
            lon=lambda: comma_number(c("lon")),
        ),
        Rule(
            "PRY",
            {
                "id": ("=codigo establecimiento",), "name": ("nombre institucion",), "sector": ("sector o tipo gestion",),
                **{f"g{i}": (word,) for i, word in enumerate(("primer", "segundo", "tercer", "cuarto", "quinto", "sexto", "septimo", "octavo", "noveno"), 1)},
            },
            before=_pry_media,
            primary=lambda: any_positive(*[c(f"g{i}") for i in range(1, 7)]) == 1,
            lower=lambda: any_positive(*[c(f"g{i}") for i in range(7, 10)]) == 1,
            upper=lambda: c("media") == 1,
            private=lambda: text("sector") == "Privado",
            lat=lambda: F.lit(None).cast("double"),
            lon=lambda: F.lit(None).cast("double"),
            collapse="school",
            after=_attach_points(
                lambda col: F.trim(col.cast("string")), {"id": ("=codigo establecimiento",), "lat": ("=latitud",), "lon": ("=longitud",)},
                lambda: dms_to_degrees(c("lat")), lambda: dms_to_degrees(c("lon")),
            ),
        ),
        Rule(
            "SLV",
            {
                "id": ("codigo",), "name": ("nombre",), "lat": ("=latitud",), "lon": ("=longitud",),
                **{f"g{g.lower()}": (f"={g}",) for g in ("1", "2", "3", "4", "5", "6", "7", "8", "9", "1A", "2A", "3A")},
            },
            primary=lambda: any_positive(*[c(f"g{i}") for i in range(1, 7)]) == 1,
            lower=lambda: any_positive(*[c(f"g{i}") for i in range(7, 10)]) == 1,
            upper=lambda: any_positive(c("g1a"), c("g2a"), c("g3a")) == 1,
            after=_slv_private,
            collapse="first",
        ),
        Rule(
            "SUR",
            {
                "kind": ("school type", "type"), "edu": ("education level", "education", "level"), "name": ("school name", "name"), "id": ("school code", "code", "id"),
                "lat": ("=latitude",), "lon": ("=longtitude", "=longitude", "=lon"),
            },
            before=_sur_ids,
            primary=lambda: text("edu") == "Primary",
            lower=lambda: text("edu").isin("Secondary - Academic", "Secondary - Vocational"),
            upper=lambda: text("edu") == "Upper Secondary",
            private=lambda: F.lower(text("kind")).isin("particulier", "private", "privada"),
            lat=lambda: F.when(F.size(F.split(text("lat"), r"\s+")) >= 4, dms_to_degrees(c("lat"))),
            lon=lambda: F.when(F.size(F.split(text("lon"), r"\s+")) >= 4, dms_to_degrees(c("lon"))),
            collapse="first",
        ),
        Rule(
            "URY",
            {"id": ("=ruee",), "name": ("=nombre",), "kind": ("tipo de ed", "tipo ed"), "x": ("=x",), "y": ("=y",)},
            before=_ury_layers,
            keep=lambda: ~upper("kind").contains("ESCUELA ESPECIAL") & ~text("id").isin("", "0", "0.0", "nan", "None"),
            primary=lambda: (c("layer") == "primary") & upper("kind").contains("ESCUELAS COMUNES"),
            lower=lambda: c("layer") != "primary",
            upper=lambda: c("layer") != "primary",
            lat=lambda: mercator_to_degrees(number(c("x")), number(c("y")))[0],
            lon=lambda: mercator_to_degrees(number(c("x")), number(c("y")))[1],
            collapse="school",
            merge_all=True,
        ),
        Rule(
            "JAM",
            {"id": ("=id centro",), "name": ("=nombre centro",), "p": ("=nivel primaria",), "b": ("=nivel secbaja",), "a": ("=nivel secalta",), "lat": ("=latitud",), "lon": ("=longitud",)},
            primary=lambda: is_true("p"),
            lower=lambda: is_true("b"),
            upper=lambda: is_true("a"),
            collapse="first",
        ),
    )
}

"""National rules on a few hand-made raw rows each."""

from __future__ import annotations

from conftest import values

from access_spark.plans.registries import RULES, standardize
from catalog import QUERIES


def frame(spark, columns, *rows):
    schema = "row_seq bigint, " + ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)


def flags(df):
    return values(df, "id_centro", "sector", "nivel_primaria", "nivel_secbaja", "nivel_secalta")


def test_chl(spark):
    main = frame(
        spark, ("RBD", "NOM_RBD", "COD_DEPE", "ENS_01", "ENS_02", "LATITUD", "LONGITUD"),
        ("1", "A", "1", "110", "310", "-33,5", "-70,5"), ("2", "B", "4", "510", "0", None, None), ("3", "C", "2", "110", "0", "-33,1", "-70,1"), ("4", "D", "1", "10", "0", None, None),
    )
    listed = frame(spark, ("RBD", "COD_ENSE"), ("1", "110"), ("4", "10"), ("3", "165"))
    out = standardize(RULES["CHL"], {"main": main, "admission": listed})
    assert flags(out) == [("1", "Public", 1, 1, 1), ("2", "Private", 0, 0, 1)]
    assert values(out, "id_centro", "latitud")[0] == ("1", -33.5)


def test_col(spark):
    main = frame(spark, ("SEDE_CODIGO", "SEDE_NOMBRE", "ESTADO_ID", "NOVEDAD_ID", "SECTOR_ID"), ("11.0", "A", "1", "9", "1"), ("12", "B", "1", "9", "2"), ("13", "C", "0", "9", "1"), ("14", "D", "1", "9", "3"))
    services = frame(spark, ("SEDE_CODIGO", "NIVELENSE_ID"), ("11", "2"), ("11", "4"), ("12.0", "3"), ("13", "2"), ("14", "1"))
    points = frame(spark, ("COD_SEDE", "LATITUD", "LONGITUD"), ("11.0", "4.5", "-74"), ("11", "9", "9"))
    out = standardize(RULES["COL"], {"main": main, "services": services, "points": points})
    assert flags(out) == [("11", "Public", 1, 0, 1), ("12", "Private", 0, 1, 0)]
    assert values(out, "id_centro", "latitud") == [("11", 4.5), ("12", None)]


def test_pry(spark):
    basic = frame(
        spark, ("codigo_establecimiento", "nombre_institucion", "sector_o_tipo_gestion", "primer_grado", "noveno_grado"), ("1", "A", "Oficial", "5", "0"), ("1", "A", "Privado", "0", "2"), ("2", "B", "Oficial", "0", None)
    )
    media = frame(spark, ("codigo_establecimiento", "nombre_institucion", "sector_o_tipo_gestion"), ("3", "C", "Oficial"))
    places = frame(spark, ("codigo_establecimiento", "latitud", "longitud"), ("1", "25°30'0\"S", "57°0'0\"W"))
    out = standardize(RULES["PRY"], {"main": basic, "media": media, "points": places})
    assert flags(out) == [("1", "Private", 1, 1, 0), ("3", "Public", 0, 0, 1)]
    assert values(out, "id_centro", "latitud", "longitud")[0] == ("1", -25.5, -57.0)


def test_ury(spark):
    main = frame(spark, ("RUEE", "Nombre", "Tipo_de_Ed", "x", "y"), ("1", "A", "Escuelas Comunes", "0", "0"), ("2", "B", "Jardin", "0", "0"), ("3", "C", "Escuela Especial", "0", "0"))
    secondary = frame(spark, ("Ruee_Calcu", "FIRST_Nomb", "x", "y"), ("4", "D", "111319.49079327357", "0"), ("0", "E", "0", "0"))
    out = standardize(RULES["URY"], {"main": main, "secondary": secondary})
    assert flags(out) == [("1", "Public", 1, 0, 0), ("4", "Public", 0, 1, 1)]
    assert abs(values(out, "id_centro", "longitud")[1][1] - 1.0) < 1e-9


def test_hnd_pan_gua(spark):
    hnd = frame(spark, ("Código Centro", "Nombre Centro", "Nivel", "Latitud", "Longitud"), ("1", "A", "Pre-Básica", None, None), ("2", "B", "Básica", "14.1", "-87"), ("3", "C", "Media", None, None), ("4", "D", "Básica Adultos", None, None))
    assert flags(standardize(RULES["HND"], {"main": hnd})) == [("2", "Public", 1, 1, 0), ("3", "Public", 0, 0, 1)]
    pan = frame(
        spark, ("Código SIACE", "Nombre del Centro", "Dependencia", "Marco del sistema", "Oferta", "Estatus"),
        ("1", "A", "OFICIAL", "Regular", "PRIMARIA Y PREMEDIA", "x"), ("2", "B", "PARTICULAR", "REGULAR", "PREMEDIA Y MEDIA", "x"), ("3", "C", "OFICIAL", "REGULAR", "PRIMARIA", "IPHE"),
    )
    points = frame(spark, ("codigo_siace", "end_lat", "end_lng"), ("2", "8.5", "-80"))
    out = standardize(RULES["PAN"], {"main": pan, "points": points})
    assert flags(out) == [("1", "Public", 1, 1, 0), ("2", "Private", 0, 1, 1)]
    assert values(out, "id_centro", "latitud") == [("1", None), ("2", 8.5)]


def test_small_sources(spark):
    bhs = frame(spark, ("Island", "Type", "Ownership", "Name", "Latitude", "Longitude"), ("Virtual", "Primary", "Private", "A", "1", "2"), ("Abaco", "All Age", "Church", "B", "26", "-77"), ("Abaco", "Secondary", "Bahamas Government", "C", "26", "-77"))
    assert flags(standardize(RULES["BHS"], {"main": bhs})) == [("BHS-001", "Unknown", 1, 1, 1), ("BHS-002", "Public", 0, 1, 1)]
    guy = frame(spark, ("Type", "School_ID", "School_Name", "Latitude", "Longitude"), ("P", "1", "A", "5", "-58"), ("SEC", "2", "B", "5", "-58"), ("N", "3", "C", "5", "-58"), ("P", "2", "late", "1", "1"))
    assert flags(standardize(RULES["GUY"], {"main": guy})) == [("1", "Public", 1, 0, 0), ("2", "Public", 0, 1, 1)]
    ecu = frame(spark, ("AMIE", "Nombre_Institución", "Tipo Educación", "Sostenimiento", "Nivel Educación"), ("17H1", "A", "Ordinaria", "Particular", "EGB y Bachillerato"), ("17H2", "B", "Especial", "Fiscal", "EGB"))
    points = frame(spark, ("AMIE", "x", "y"), ("17H1", "500000", "10000000"))
    out = standardize(RULES["ECU"], {"main": ecu, "points": points})
    assert flags(out) == [("17H1", "Private", 1, 1, 1)] and values(out, "latitud", "longitud")[0][1] == -81.0


def test_addresses_of_schools_with_long_numbers(spark, tmp_path):
    keys = (7, 12345, 100000, 100001, 1000012)
    rows = [(k, f"Customer {k}", 1, 0.0, "BUILDING") for k in keys]
    spark.createDataFrame(rows, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    out = QUERIES["extracted_addresses"](spark, str(tmp_path)).filter("adm0_pcode = 'DOM'")
    assert values(out, "id_centro", "raw_adm2") == sorted((f"{k:05d}", f"Customer {k}") for k in keys)

"""Declared places of every school: one configuration row per source, one job for all."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_spark.functions.text import admin_code, blank_null_words, extract, fuzzy_column, numbered_id
from access_spark.operators.keyed import keep_first, union_columns

SAME = "same"


@dataclass(frozen=True)
class Source:
    """Columns of one source. `id` is a header, a pair of headers joined by '-', or None for
    the first column; `id_pattern` extracts the id from it; `id_prefix` numbers the rows.
    qc_adm1/qc_adm2 are the columns compared with polygons (SAME: as declared)."""

    country: str
    id: str | tuple[str, str] | None = None
    adm1: str | None = None
    adm2: str | None = None
    qc_adm1: str | None = SAME
    qc_adm2: str | None = SAME
    locality: str | None = None
    locality_code: str | None = None
    street: str | None = None
    code1: tuple[str, str, int] | None = None  # header, prefix, width
    code2: tuple[str, str, int] | None = None
    id_pattern: str | None = None
    id_prefix: str | None = None
    level: int = 1


# Headers and code formats of the published sources.
SOURCES: dict[str, Source] = {
    "ARG": Source("Argentina", "cueanexo", "provincia", "departamento", locality="localidad", street="ndomicilio", code1=("cod_prov", "AR", 3)),
    "BHS": Source("Bahamas", None, "Area Education", qc_adm2=None, locality="Settlement", street="Address", id_prefix="BHS-"),
    "BLZ": Source("Belize", "Code", "Area Administrative", street="Address"),
    "BOL": Source("Bolivia", "Codigo R.U.E.", "Departamento", "Municipio", qc_adm2=None, street="Dirección", code1=("Departamento Código", "BO", 2)),
    "BRA": Source("Brazil", "CO_ENTIDADE", "NO_UF", "NO_MUNICIPIO", locality="NO_BAIRRO", street="DS_ENDERECO", code1=("CO_UF", "BR", 2)),
    "COL": Source("Colombia", "SEDE_CODIGO", "DEPTO", "MUNI", locality="LOCALIDAD", street="SEDE_DIRECCION", code1=("CODIGOINTERNODEPTO", "CO", 2), code2=("CODIGOINTERNOMUNI", "CO", 5)),
    "CRI": Source("Costa Rica", "CODPRES", "PROVINCIA", "CANTON", locality="POBLADO", street="DIRECCION"),
    "GTM": Source("Guatemala", "código", "departamen", "municipio", street="dirección"),
    "GUY": Source("Guyana", "School_ID", "Region_No", street="Address"),
    "HND": Source("Honduras", "Código Centro", "Departamento", "Municipio", street="DireccionCentro"),
    "MEX": Source("Mexico", "id_centro", "nombre_entidad", "nombre_municipio", locality="nombre_localidad", street="domicilio_completo", code1=("clave_entidad", "MX", 2)),
    "PER": Source("Peru", ("COD_MOD", "ANEXO"), "DPTO", "PROV", locality="LOCALIDAD", street="DIRECCION"),
    "PRY": Source("Paraguay", "codigo_establecimiento", "nombre_departamento", "nombre_distrito", locality="nombre_barrio_localidad", street="direccion"),
    "SLV": Source("El Salvador", None, "DEPARTAMENTO", "MUNICIPIO"),
    "SUR": Source("Suriname", "School code", "District", "Ressort", locality="Settlement area", street="Address"),
    "URY": Source("Uruguay", "id_centro", "departamento", "paraje", qc_adm2=None, street="calle"),
    "CHL": Source("Chile", "id_centro", "provincia_bid", "comuna", qc_adm1=None, qc_adm2="provincia_bid", code1=("cod_reg_rbd", "CL", 2), level=2),
    "ECU": Source("Ecuador", "AMIE", "Provincia", "Cantón", locality="Parroquia", locality_code="Cod_Parroquia", code1=("Cod_Provincia", "EC", 2), code2=("Cod_Cantón", "EC", 4)),
    "DOM": Source("Dominican Republic", "Centros", "Provincia", "Municipio", qc_adm1=None, qc_adm2="Provincia", id_pattern=r"^(\d+)", level=2),
    "PAN": Source("Panama", "Código SIACE", "Provincia", "Distrito", locality="Corregimiento"),
}


def extract_addresses(iso: str, raw: DataFrame, source: Source | None = None) -> DataFrame:
    """One row per school id (its first) with the declared places and codes."""
    source = source or SOURCES[iso]
    headers = [h for h in raw.columns if h != "row_seq"]

    def raw_text(name: str | None) -> Column:
        header = fuzzy_column(headers, name)
        return F.col(f"`{header}`") if header else F.lit(None).cast("string")

    def place(name: str | None) -> Column:
        return blank_null_words(raw_text(name))

    def code(spec: tuple[str, str, int] | None) -> Column:
        return admin_code(raw_text(spec[0]), spec[1], spec[2]) if spec else F.lit("")

    if source.id_prefix:
        key = numbered_id(source.id_prefix, F.col("row_seq"), 3)
    elif isinstance(source.id, tuple):
        key = F.concat_ws("-", *[raw_text(part).cast("string") for part in source.id])
    else:
        key = F.trim((raw_text(source.id) if source.id else F.col(f"`{headers[0]}`")).cast("string"))
        if source.id_pattern:
            key = extract(key, source.id_pattern)
    declared = {1: source.adm1, 2: source.adm2}
    compared = {1: source.qc_adm1, 2: source.qc_adm2}
    rows = raw.select(
        F.lit(iso).alias("adm0_pcode"), key.alias("id_centro"),
        *[place(declared[lv]).alias(f"raw_adm{lv}") for lv in (1, 2)],
        *[place(declared[lv] if compared[lv] == SAME else compared[lv]).alias(f"qc_raw_adm{lv}") for lv in (1, 2)],
        place(source.locality).alias("raw_locality"), place(source.locality_code).alias("raw_locality_code"),
        place(source.street).alias("raw_street"), code(source.code1).alias("raw_adm1_code"), code(source.code2).alias("raw_adm2_code"),
        "row_seq",
    )
    return keep_first(rows, ["adm0_pcode", "id_centro"], F.col("row_seq")).drop("row_seq")


def extract_all(raws: Mapping[str, DataFrame]) -> DataFrame:
    return union_columns(*[extract_addresses(iso, raw) for iso, raw in raws.items()])

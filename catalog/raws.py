"""Queries on national registries, addresses and admin files, over raw tables derived from
the given ones."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from access_spark.plans import addresses, preprocess, registries
from access_spark.session import shared_dir
from access_spark.sources import readers
from catalog.domain import Tables
from catalog.registry import query


def _pick(*pairs):
    """CASE over c_custkey % n: values by remainder."""
    k = F.col("c_custkey") % len(pairs)
    out = F.when(k == 0, F.lit(pairs[0]))
    for i, value in enumerate(pairs[1:], start=1):
        out = out.when(k == i, F.lit(value))
    return out


def raw_registries(t: Tables):
    k = F.col("c_custkey")
    base = t.customer
    seq = k.alias("row_seq")
    x = lambda cond: F.when(cond, "X")
    return {
        "ARG": {
            "main": base.select(
                seq, k.cast("string").alias("cueanexo"), F.col("c_name").alias("Nombre"), (k % 4).alias("sector"), x(k % 5 != 0).alias("comun"),
                x(k % 2 == 0).alias("comun_primaria"), x(k % 3 == 0).alias("comun_cb"), x(k % 7 == 0).alias("comun_co"), x(k % 11 == 0).alias("comun_ambos"),
                F.col("c_acctbal").cast("string").alias("latitud"), F.when(k % 13 != 0, "-60.5").otherwise("s/d").alias("longitud"), F.lit("unused").alias("extra"),
            )
        },
        "BOL": {
            "main": base.select(
                seq, k.alias("Codigo R.U.E."), F.col("c_name").alias("Institución"), _pick("Regular", "Alternativa", "Regular").alias("Sub Sistema"),
                _pick("Nivel Primaria", "Nivel Secundaria", "Inicial", "primaria y secundaria").alias("Nivel Autorizado"),
                _pick("Fiscal", " PRIVADA ", "Convenio", "Fiscal", "Privada mixta").alias("Dependencia"), (-(k % 40)).alias("Latitud"), (-(k % 90)).alias("Longitud"),
            )
        },
        "GTM": {
            "main": base.select(
                seq, F.concat(F.lit("G"), (k % 700).cast("string")).alias("codigo"), F.when(k > 100, F.col("c_name")).alias("nombre"),
                _pick("PRIMARIA", "BASICO", "DIVERSIFICADO", "PRIMARIA DE ADULTOS", "PARVULOS").alias("nivel"), _pick("OFICIAL", "PRIVADO", "MUNICIPAL").alias("sector"),
                _pick("ABIERTA", "ABIERTA", "ABIERTA", "ABIERTA", "ABIERTA", "ABIERTA", "Cerrada definitivamente").alias("situacion"),
                _pick("0", "14.5", "", "15.25").alias("latitud"), F.lit("-90.5").alias("longitud"),
            )
        },
        "MEX": {
            "main": base.select(
                seq, F.concat(F.lit("M"), (k % 900).cast("string")).alias("id_centro"), F.col("c_name").alias("nombre_centro"), _pick("Primaria", "SECUNDARIA", "bachillerato", "INICIAL").alias("nivel"),
                _pick("PÚBLICO", "privado").alias("control"), F.lit("19.5").alias("latitud"), F.lit("-99.1").alias("longitud"),
            )
        },
        "SUR": {
            "main": base.select(
                seq, F.when(k % 9 != 0, F.concat(F.lit("S"), k.cast("string"))).alias("School code"), F.col("c_name").alias("School name"), _pick("Primary", "Secondary - Vocational", "Upper Secondary", "Nursery").alias("Education level"),
                _pick("Openbaar", "Particulier").alias("School type"), F.concat((k % 6).cast("string"), F.lit(" 30 0 N")).alias("Latitude"), F.lit("55 15 0 W").alias("Longtitude"),
            )
        },
        "PER": {
            "main": base.select(
                seq, k.cast("string").alias("COD_MOD"), (k % 2).cast("string").alias("ANEXO"), F.col("c_name").alias("CEN_EDU"), _pick("B0", "F0", "A1").alias("NIV_MOD"),
                _pick("Escolarizada", "Escolarizada", "Escolarizada", "No escolarizada").alias("D_FORMA"), (k % 4).alias("GESTION"), F.lit("-12,05").alias("NLAT_IE"), F.lit("-77,03").alias("NLONG_IE"),
            ),
            "enrolment": base.select(
                seq, k.cast("string").alias("COD_MOD"), _pick("B0", "F0", "A1").alias("NIV_MOD"), *[F.when(k % (i + 2) == 1, i).otherwise(0).alias(f"D{i:02d}") for i in range(1, 11)]
            ),
        },
        "BRA": {
            "main": base.select(
                seq, k.alias("CO_ENTIDADE"), F.col("c_name").alias("NO_ENTIDADE"), (k % 5).alias("TP_DEPENDENCIA"), (1 + k % 3).alias("TP_SITUACAO_FUNCIONAMENTO"),
                (k % 2).alias("IN_FUND_AI"), (k % 3 == 0).cast("int").alias("IN_FUND_AF"), F.when(k % 7 == 0, 1).alias("IN_MED"),
            ),
            "survey": base.filter("c_custkey % 4 = 0").select(seq, k.cast("string").alias("id_centro"), F.lit(-10.0).alias("latitud"), F.lit(-50.0).alias("longitud")),
            "connected": base.filter("c_custkey % 3 = 0").select(seq, k.cast("string").alias("id_centro"), F.lit(-11.0).alias("latitud"), F.lit(-51.0).alias("longitud")),
        },
    }


def _case(*values: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE k % {len(values)} {whens} END"


STANDARD = f"""WITH c AS (SELECT c_custkey AS k, c_name AS nm, c_acctbal AS v FROM customer),
    arg AS (SELECT 'ARG' AS iso, cast(k AS varchar) AS id, nm, CASE WHEN k % 4 = 2 THEN 'Private' ELSE 'Public' END AS sector, cast(k % 2 = 0 AS int) AS p, cast(k % 3 = 0 OR k % 11 = 0 AS int) AS b, cast(k % 7 = 0 OR k % 11 = 0 AS int) AS a,
      v AS la, CASE WHEN k % 13 <> 0 THEN -60.5e0 END AS lo FROM c WHERE k % 4 IN (1, 2) AND k % 5 <> 0),
    bol AS (SELECT 'BOL', cast(k AS varchar), nm, CASE WHEN k % 5 = 1 THEN 'Private' ELSE 'Public' END, cast(k % 4 IN (0, 3) AS int), cast(k % 4 IN (1, 3) AS int), cast(k % 4 IN (1, 3) AS int),
      CASE WHEN k % 40 <= 23 THEN -(k % 40)::double END, CASE WHEN k % 90 BETWEEN 57 AND 70 THEN -(k % 90)::double END FROM c WHERE k % 3 <> 1),
    g0 AS (SELECT k, 'G' || (k % 700) AS id, CASE WHEN k > 100 THEN nm END AS nm, {_case('PRIMARIA', 'BASICO', 'DIVERSIFICADO', 'PRIMARIA DE ADULTOS', 'PARVULOS')} AS lv, k % 3 = 1 AS pr, CASE k % 4 WHEN 1 THEN 14.5e0 WHEN 3 THEN 15.25e0 END AS la FROM c WHERE k % 7 <> 6),
    gtm AS (SELECT 'GTM', id, arg_min(nm, k) FILTER (nm IS NOT NULL), CASE WHEN bool_or(pr) THEN 'Private' ELSE 'Public' END, max(cast(lv = 'PRIMARIA' AS int)), max(cast(lv = 'BASICO' AS int)), max(cast(lv = 'DIVERSIFICADO' AS int)), arg_min(la, k) FILTER (la IS NOT NULL), -90.5e0
      FROM g0 WHERE lv IN ('PRIMARIA', 'BASICO', 'DIVERSIFICADO') GROUP BY id),
    mex AS (SELECT 'MEX', 'M' || (k % 900), arg_min(nm, k), arg_min(CASE WHEN k % 2 = 1 THEN 'Private' ELSE 'Public' END, k), arg_min(cast(k % 4 = 0 AS int), k), arg_min(cast(k % 4 = 1 AS int), k), arg_min(cast(k % 4 = 2 AS int), k), 19.5e0, -99.1e0
      FROM c WHERE k % 4 <> 3 GROUP BY k % 900),
    sur AS (SELECT 'SUR', CASE WHEN k % 9 <> 0 THEN 'S' || k ELSE 'SUR_NOID_' || lpad(cast(row_number() OVER (PARTITION BY k % 9 = 0 ORDER BY k) AS varchar), 3, '0') END, nm, CASE WHEN k % 2 = 1 THEN 'Private' ELSE 'Public' END,
      cast(k % 4 = 0 AS int), cast(k % 4 = 1 AS int), cast(k % 4 = 2 AS int), k % 6 + 0.5e0, -55.25e0 FROM c WHERE k % 4 <> 3),
    e AS (SELECT k, cast({' OR '.join(f'k % {i + 2} = 1' for i in range(1, 5))} AS int) AS lo4, cast({' OR '.join(f'k % {i + 2} = 1' for i in range(5, 11))} AS int) AS hi6 FROM c WHERE k % 3 = 1),
    per AS (SELECT 'PER', c.k || '-' || (c.k % 2), nm, CASE WHEN c.k % 4 = 3 THEN 'Private' ELSE 'Public' END, cast(c.k % 3 = 0 AS int), coalesce(lo4, 0), coalesce(hi6, 0), -12.05e0, -77.03e0
      FROM c LEFT JOIN e ON e.k = c.k WHERE c.k % 3 <> 2 AND c.k % 4 <> 3),
    bra AS (SELECT 'BRA', cast(k AS varchar), nm, CASE WHEN k % 5 = 4 THEN 'Private' ELSE 'Public' END, k % 2, cast(k % 3 = 0 AS int), cast(k % 7 = 0 AS int), CASE WHEN k % 4 = 0 THEN -10e0 WHEN k % 3 = 0 THEN -11e0 END, CASE WHEN k % 4 = 0 THEN -50e0 WHEN k % 3 = 0 THEN -51e0 END FROM c WHERE k % 3 = 0)
    SELECT iso AS adm0_pcode, id AS id_centro, nm AS nombre_centro, sector, p AS nivel_primaria, b AS nivel_secbaja, a AS nivel_secalta, round(la, 6) AS latitud, round(lo, 6) AS longitud
    FROM (SELECT * FROM arg UNION ALL SELECT * FROM bol UNION ALL SELECT * FROM gtm UNION ALL SELECT * FROM mex UNION ALL SELECT * FROM sur UNION ALL SELECT * FROM per UNION ALL SELECT * FROM bra) WHERE p + b + a > 0"""


@query("standardized_registries", STANDARD)
def _standardized(t: Tables):
    out = registries.standardize_all(raw_registries(t)).drop("row_seq")
    return out.withColumns({c: F.round(c, 6) for c in ("latitud", "longitud")})


def _as_text(df, sep: str, folder: str, titles: int = 0, quote: bool = True):
    """Write a raw table as delimited text, rows in their order after a header: fields that
    hold the separator, a line break or a leading quote are quoted, other quotes stay bare."""

    def field(name: str):
        value = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
        wrapped = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
        needed = F.contains(value, F.lit(sep)) | F.contains(value, F.lit("\n")) | value.startswith('"')
        return F.when(needed, wrapped).otherwise(value) if quote else value

    names = [c for c in df.columns if c != "row_seq"]
    head = [f"title {i}" for i in range(titles)] + [sep.join(names)]
    lines = df.select("row_seq", F.concat_ws(sep, *[field(c) for c in names]).alias("value"))
    top = df.sparkSession.createDataFrame([(i - len(head), h) for i, h in enumerate(head)], "row_seq long, value string")
    top.union(lines).orderBy("row_seq").select("value").write.text(folder)
    return folder


@query(
    "registry_from_text",
    STANDARD.split(" SELECT iso AS adm0_pcode")[0].strip()
    + """,
    named AS (SELECT c_name AS nm, c_custkey AS k FROM customer),
    a AS (SELECT arg.iso, id, sector, p, b, a, la, lo, CASE k % 3 WHEN 0 THEN n.nm || ' 5" red' WHEN 1 THEN n.nm || ', "x"' || chr(10) || 'y' ELSE '"' || n.nm || '"' END AS nm
      FROM arg JOIN named n ON cast(k AS varchar) = id),
    b AS (SELECT iso, id, sector, p, b, a, la, lo, nm FROM bol AS t(iso, id, nm, sector, p, b, a, la, lo)),
    m AS (SELECT iso, id, sector, p, b, a, la, lo, 'No. 1 Norte ' || nm AS nm FROM mex AS t(iso, id, nm, sector, p, b, a, la, lo))
    SELECT iso AS adm0_pcode, id AS id_centro, nm AS nombre_centro, sector, p AS nivel_primaria, b AS nivel_secbaja, a AS nivel_secalta, round(la, 6) AS latitud, round(lo, 6) AS longitud
    FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM m) WHERE p + b + a > 0""",
)
def _from_text(t: Tables):
    """Files of three registries, read in parallel and standardised: bare, quoted and doubled
    quotes and line breaks inside fields; title lines; separators that need a repair."""
    raws, k, folder = raw_registries(t), F.col("row_seq"), f"{shared_dir(t.spark)}/registries-{uuid.uuid4().hex}"
    name = F.col("Nombre")
    spoilt = F.when(k % 3 == 0, F.concat(name, F.lit(' 5" red'))).when(k % 3 == 1, F.concat(name, F.lit(', "x"\ny'))).otherwise(F.concat(F.lit('"'), name, F.lit('"')))
    arg = _as_text(raws["ARG"]["main"].withColumn("Nombre", spoilt), ",", f"{folder}/arg")
    bol = _as_text(raws["BOL"]["main"], ";", f"{folder}/bol", titles=2)
    mex = raws["MEX"]["main"].withColumn("nombre_centro", F.concat(F.lit("No. 1, Norte "), "nombre_centro"))
    mex = _as_text(mex, ",", f"{folder}/mex", quote=False)
    read = {
        "ARG": {"main": readers.read_delimited(t.spark, arg)},
        "BOL": {"main": readers.read_after_title(t.spark, bol, 2, ";")},
        "MEX": {"main": readers.read_repaired(t.spark, mex, {"No. 1, Norte": "No. 1 Norte"})},
    }
    out = registries.standardize_all(read).drop("row_seq")
    return out.withColumns({c: F.round(c, 6) for c in ("latitud", "longitud")})


@query(
    "extracted_addresses",
    """WITH c AS (SELECT c_custkey AS k, c_name AS nm, c_mktsegment AS m FROM customer),
      a AS (SELECT 'ARG' AS adm0_pcode, 'A' || (k % 1100) AS id_centro, arg_min(CASE WHEN k % 5 = 0 THEN '' ELSE m END, k) AS raw_adm1, arg_min(nm, k) AS raw_adm2, arg_min(CASE WHEN k % 5 = 0 THEN '' ELSE m END, k) AS qc_raw_adm1, arg_min(nm, k) AS qc_raw_adm2,
        '' AS raw_locality, '' AS raw_locality_code, arg_min('Calle ' || k, k) AS raw_street, arg_min(CASE WHEN k % 3 = 0 THEN '' ELSE 'AR' || lpad(cast(k % 24 AS varchar), 3, '0') END, k) AS raw_adm1_code, '' AS raw_adm2_code FROM c GROUP BY k % 1100),
      d AS (SELECT 'DOM', lpad(cast(k AS varchar), 5, '0'), m, nm, '', m, '', '', '', '', '' FROM c),
      e AS (SELECT 'ECU', cast(k AS varchar), m, nm, m, nm, '', cast(k % 7 AS varchar), '', 'EC' || lpad(cast(k % 24 AS varchar), 2, '0'), 'EC' || lpad(cast(100 + k % 24 AS varchar), 4, '0') FROM c),
      p AS (SELECT 'PER', k || '-' || (k % 3), m, nm, m, nm, nm, '', m, '', '' FROM c),
      b AS (SELECT 'BHS', 'BHS-' || lpad(cast(k AS varchar), cast(greatest(3, length(cast(k AS varchar))) AS int), '0'), m, '', m, '', nm, '', '', '', '' FROM c)
      SELECT * FROM a UNION ALL SELECT * FROM d UNION ALL SELECT * FROM e UNION ALL SELECT * FROM p UNION ALL SELECT * FROM b""",
)
def _addresses(t: Tables):
    k, name, segment = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    seq = k.alias("row_seq")
    raws = {
        "ARG": t.customer.select(
            F.concat(F.lit(" A"), (k % 1100).cast("string")).alias("Cueanexo"), F.when(k % 5 == 0, "nan").otherwise(segment).alias("Provincia"), name.alias("departamento"),
            F.concat(F.lit("Calle "), k.cast("string")).alias("ndomicilio"), F.when(k % 3 == 0, "x").otherwise(F.concat((k % 24).cast("string"), F.lit(".0"))).alias("cod_prov"), seq,
        ),
        "DOM": t.customer.select(F.concat(F.format_string("%05d", k), F.lit(" - "), name).alias("CENTROS"), segment.alias("Provincia"), name.alias("Municipio"), seq),
        "ECU": t.customer.select(
            k.alias("AMIE"), segment.alias("Provincia"), name.alias("Canton"), (k % 7).alias("Cod_Parroquia"), (k % 24).alias("Cod_Provincia"), (100 + k % 24).alias("Cod_Canton"), seq
        ),
        "PER": t.customer.select(k.alias("COD_MOD"), (k % 3).alias("ANEXO"), segment.alias("DPTO"), name.alias("PROV"), name.alias("LOCALIDAD"), segment.alias("DIRECCION"), seq),
        "BHS": t.customer.select(name.alias("Settlement"), segment.alias("Area Education"), seq),
    }
    return addresses.extract_all(raws)


@query(
    "combined_admin_files",
    """WITH l AS (SELECT c_custkey AS k, cast(c_custkey % 900 AS varchar) AS id, CASE WHEN c_custkey % 2 = 0 THEN 'PAYSANDÚ' ELSE 'SAN JOSÉ' END AS d, 0 AS layer FROM customer WHERE c_custkey % 3 <> 0
        UNION ALL SELECT c_custkey, cast(c_custkey AS varchar), 'ROCHA', 1 FROM customer WHERE c_custkey % 3 = 0),
      f AS (SELECT id, arg_min(d, layer * 100000000 + k) AS d FROM l WHERE id <> '0' GROUP BY 1)
      SELECT id AS id_centro, d AS departamento, CASE WHEN c_custkey IS NOT NULL THEN c_mktsegment END AS localidad,
        CASE WHEN c_custkey IS NOT NULL THEN CASE WHEN c_custkey % 4 = 0 THEN 'Ruta' ELSE 'Ruta ' || c_custkey END END AS calle
      FROM f LEFT JOIN customer ON cast(c_custkey AS varchar) = id AND c_custkey % 5 <> 0""",
)
def _combined(t: Tables):
    k = F.col("c_custkey")
    spoilt = lambda text: F.decode(F.encode(F.lit(text), "UTF-8"), "ISO-8859-1")
    one = t.customer.filter(k % 3 != 0).select(
        k.alias("row_seq"), (k % 900).cast("string").alias("id"), F.when(k % 2 == 0, spoilt("PAYSANDÚ")).otherwise("SAN JOSÉ").alias("department")
    )
    two = t.customer.filter(k % 3 == 0).select(k.alias("row_seq"), F.concat(F.lit(" "), k.cast("string")).alias("id"), F.lit("ROCHA").alias("department"))
    places = t.customer.select(
        k.alias("row_seq"), F.concat(k.cast("string"), F.lit(".0")).alias("ruee"), F.when(k % 5 == 0, "CFE").otherwise("CES").alias("subsystem"), F.col("c_mktsegment").alias("localidad"),
        F.lit("p").alias("paraje"), F.lit("Ruta").alias("calle"), F.when(k % 4 == 0, "S/N").otherwise(k.cast("string")).alias("n_de_puerta"),
    )
    out = preprocess.combined_admin([one, two], places)
    return out.select("id_centro", "departamento", "localidad", "calle")


@query(
    "province_names_by_code",
    """SELECT cast(c_custkey AS varchar) AS id_centro, CASE WHEN c_custkey % 30 < 25 THEN 'NATION_' || (c_custkey % 30) END AS provincia_bid, c_custkey % 16 AS cod_reg_rbd FROM customer""",
)
def _province(t: Tables):
    k = F.col("c_custkey")
    units = t.nation.select(F.format_string("CL%03d", "n_nationkey").alias("pcode"), F.col("n_name").alias("name"))
    directory = t.customer.select(k.alias("id"), (k % 30).alias("province_code"), F.lit("x").alias("comuna"), (k % 16).alias("region_code"))
    return preprocess.names_by_code(directory, units, "CL").drop("comuna")

"""Published settings: contracts, enumerations and policies.

All values here are fixed values of the public data contract; they are stated as
text so that results carry the same labels.
"""

from __future__ import annotations

# ---- table contracts -----------------------------------------------------------
BASE_COLUMNS = {
    "id_centro": "string", "nombre_centro": "string", "sector": "string",
    "nivel_primaria": "int", "nivel_secbaja": "int", "nivel_secalta": "int",
    "latitud": "double", "longitud": "double", "adm0_pcode": "string",
}
ENRICHED_COLUMNS = {
    **BASE_COLUMNS, "id_national": "string", "year": "int",
    "latitud_geocoded": "double", "longitud_geocoded": "double", "geocode_distance_km": "double",
    "arcgis_score": "double", "geocode_source": "string", "geocode_precision": "string",
    "acceptance": "string", "adm1_pcode": "string", "adm2_pcode": "string",
    "qc_in_bounds": "boolean", "qc_scope_class": "string",
    "include_in_spatial_indicators": "boolean", "qc_swapped": "boolean",
    "qc_adm1_status": "string", "qc_adm2_status": "string", "qc_match_level": "string",
    "qc_distance_to_raw_polygon_km": "double",
    "qc_cluster_size_exact": "bigint", "qc_cluster_diff_addr_exact": "boolean",
    "qc_cluster_size_50m": "bigint", "qc_cluster_diff_addr_50m": "boolean",
    "qc_cluster_diff_admin_locality": "boolean", "qc_n2_frontier_rescue": "boolean",
    "geocoded_in_adm1": "string", "geocoded_in_adm2": "string",
    "geo_adm1_check": "string", "geo_adm2_check": "string",
    "original_in_adm1": "string", "original_in_adm2": "string",
    "orig_adm1_check": "string", "orig_adm2_check": "string",
    "raw_adm1_code": "string", "raw_adm2_code": "string",
    "coordinate_source": "string", "coordinate_quality": "string",
    "coordinate_quality_reason": "string", "qc_centroid_bias": "string",
    "qc_evidence_version": "int",
}
CUBE_KEY = (
    "isoalpha3", "idgeo", "admin1_pcode", "admin2_pcode", "indicator", "mode",
    "education_level", "age", "sector", "area", "quintile", "time_band",
)
CUBE_COLUMNS = (
    "isoalpha3", "idgeo", "admin1_pcode", "admin1_name", "admin2_pcode", "admin2_name",
    "indicator", "mode", "education_level", "age", "sector", "area", "quintile",
    "time_band", "value", "population_base", "year", "method", "source",
)
LEDGER_COLUMNS = (
    "iso", "id_centro", "nombre_centro", "geocoded_lat", "geocoded_lon", "geocode_source",
    "geocode_precision", "arcgis_score", "geocode_query", "geocode_distance_km", "target_type",
    "original_lat", "original_lon", "geocoded_in_adm1", "geocoded_in_adm2", "geo_adm1_check",
    "geo_adm2_check", "original_in_adm1", "original_in_adm2", "orig_adm1_check",
    "orig_adm2_check", "acceptance", "adm1_check", "adm2_check",
)

# ---- enumerations ---------------------------------------------------------------
QUALITY_LABELS = (
    "missing", "out_of_bounds", "swapped", "adm_mismatch", "cluster_centroid",
    "geocoder_disagrees", "boundary_zone", "geocoded_centroid", "geocoded_street",
    "gps_validated", "gps_unverified",
)
QUALITY_REASONS = (
    "bbox", "swapped", "adm2_mismatch", "adm1_mismatch", "cluster_ge5",
    "cluster_3_4_diff_admin_locality", "cluster_2_diff_admin_locality", "geocoder_compare",
    "boundary_zone_<5km", "geocoder_low_confidence", "fill_centroid", "fill_street",
    "validated", "default_unverified", "missing",
)
SCOPE_CLASSES = (
    "missing", "inside_mainland_bbox", "remote_territory_or_island", "near_border_review",
    "outside_country", "invalid_numeric",
)
COORDINATE_SOURCES = ("original", "geocoded", "centroid_cascade")
CENTROID_BIASES = ("normal", "high", "unknown")
ADMIN_STATUSES = ("MATCH", "MISMATCH", "NO_RAW_ADM", "NO_POLYGON", "NO_DATA", "NOT_RUN")
MATCH_LEVELS = {"adm2": "ADM2", "adm1": "ADM1", "spatial_only": "SPATIAL_ONLY", "bbox_only": "NONE"}
FILL_ACCEPTED = ("ACCEPT", "ACCEPT_WITH_FLAG", "ACCEPT_CENTROID")
AUDIT_COLUMNS = (
    "geocoded_in_adm1", "geocoded_in_adm2", "geo_adm1_check", "geo_adm2_check",
    "original_in_adm1", "original_in_adm2", "orig_adm1_check", "orig_adm2_check",
)
# earlier source names -> (coordinate_source, qc_centroid_bias)
LEGACY_SOURCES = {
    "adm3_centroid": ("centroid_cascade", "normal"),
    "adm3_centroid_large": ("centroid_cascade", "high"),
    "original": ("original", "unknown"),
    "geocoded": ("geocoded", "unknown"),
}

# ---- thresholds -------------------------------------------------------------------
CLUSTER_THRESHOLD = 5
CLUSTER_BIN_DEGREES = 50.0 / 111_320.0
GEOCODER_DISAGREE_KM = 10.0
BOUNDARY_ZONE_KM = 5.0
BORDER_REVIEW_KM = 5.0
NAME_RESCUE_KM = 1.0
WEALTH_MASK_KM = 5.0
EVIDENCE_VERSION = 2
URBAN_MIN_DENSITY = 300.0
URBAN_MIN_POPULATION = 5000.0
SETTLEMENT_MIN_DENSITY = 150.0
SETTLEMENT_MIN_POPULATION = 200.0
GRID_PITCH = 1.0 / 120.0

# ---- indicator cube ------------------------------------------------------------------
MODES = ("walking", "motorized")
TIME_BANDS = (15, 30, 60)
LEVELS = {  # level: (age label, population column, level flag)
    "primaria": ("05_09", "pop_5_9", "nivel_primaria"),
    "secbaja": ("10_14", "pop_10_14", "nivel_secbaja"),
    "secalta": ("15_19", "pop_15_19", "nivel_secalta"),
}
SECTOR_LABELS = {"total": "Total", "public": "Public", "private": "Private"}
AREA_LABELS = {"urbana": "urban", "no_urbana": "semiurban", "dispersa": "rural"}
INDICATOR = "acceso_geografico"
POPULATION_YEAR = 2023
ADMIN1_ONLY = ("URY",)

# ---- countries: (analysis included, final match level, validation tier, data status) ----
COUNTRIES = {
    "ARG": (True, "adm2", "standard", "ready"),
    "BHS": (True, "adm1", "limited", "ready"),
    "BLZ": (True, "adm1", "standard", "ready"),
    "BOL": (True, "adm1", "standard", "ready"),
    "BRA": (True, "adm2", "standard", "ready"),
    "BRB": (True, "bbox_only", "limited", "limited_source"),
    "CHL": (True, "adm2", "standard", "ready"),
    "COL": (True, "adm2", "standard", "ready"),
    "CRI": (True, "adm2", "standard", "ready"),
    "DOM": (True, "adm2", "standard", "ready"),
    "ECU": (True, "adm2", "standard", "ready"),
    "GTM": (True, "adm2", "standard", "ready"),
    "GUY": (True, "adm1", "standard", "ready"),
    "HND": (True, "adm2", "standard", "ready"),
    "HTI": (False, "bbox_only", "not_ready", "limited_source"),
    "JAM": (True, "spatial_only", "limited", "no_raw_ministry_file"),
    "MEX": (True, "adm2", "standard", "ready"),
    "PAN": (True, "adm2", "standard", "ready"),
    "PER": (True, "adm2", "standard", "ready"),
    "PRY": (True, "adm2", "standard", "ready"),
    "SLV": (True, "adm2", "standard", "ready"),
    "SUR": (True, "adm2", "standard", "ready"),
    "URY": (True, "adm1", "standard", "ready"),
}
# (lat_min, lat_max, lon_min, lon_max)
COUNTRY_BOXES = {
    "ARG": (-56.0, -21.0, -74.0, -53.0),
    "BHS": (20.9, 27.3, -79.4, -72.7),
    "BLZ": (15.5, 18.6, -89.5, -87.3),
    "BOL": (-23.0, -9.0, -70.0, -57.0),
    "BRA": (-34.0, 6.0, -74.0, -34.0),
    "BRB": (13.0, 13.4, -59.7, -59.4),
    "CHL": (-56.0, -17.5, -76.0, -66.0),
    "COL": (-4.3, 12.5, -79.1, -66.8),
    "CRI": (8.0, 11.3, -86.0, -82.5),
    "DOM": (17.5, 20.0, -72.2, -68.2),
    "ECU": (-5.1, 1.5, -81.1, -75.2),
    "GTM": (13.5, 18.0, -92.5, -88.0),
    "GUY": (1.0, 9.0, -62.0, -56.0),
    "HND": (12.5, 16.5, -90.0, -83.0),
    "HTI": (17.9, 20.3, -74.5, -71.6),
    "JAM": (17.7, 18.6, -78.4, -76.1),
    "MEX": (14.0, 33.0, -118.0, -86.0),
    "PAN": (7.1, 9.7, -83.1, -77.1),
    "PER": (-18.5, 0.5, -82.0, -68.0),
    "PRY": (-28.0, -19.0, -63.0, -54.0),
    "SLV": (13.0, 14.5, -90.2, -87.6),
    "SUR": (1.8, 6.1, -58.1, -53.9),
    "URY": (-35.2, -30.0, -58.5, -53.0),
}
# iso3 -> country code used by the boundary layer
BOUNDARY_CODES = {
    "ARG": "ARG", "BHS": "BHS", "BLZ": "BZ", "BOL": "BO", "BRA": "BR", "BRB": "BB", "CHL": "CL",
    "COL": "CO", "CRI": "CR", "DOM": "DO", "ECU": "EC", "GTM": "GT", "GUY": "GY", "HND": "HN",
    "HTI": "HT", "JAM": "JAM", "MEX": "MX", "NIC": "NI", "PAN": "PA", "PER": "PE", "PRY": "PY",
    "SLV": "SV", "SUR": "SR", "TTO": "TT", "URY": "UY", "VEN": "VE",
}

# ---- admin names: raw name -> polygon name, both normalised --------------------------------
ADMIN_ALIASES = {
    (1, "MEX"): {
        "ciudad de mexico": "distrito federal",
        "queretaro": "queretaro de arteaga",
    },
    (1, "GTM"): {"ciudad capital": "guatemala"},
    (1, "PRY"): {"capital": "asuncion"},
    (1, "GUY"): {
        "region 1": "barima-waini",
        "region 2": "pomeroon-supenaam",
        "region 3": "essequibo islands-west demerara",
        "region 4": "demerara-mahaica",
        "region 5": "mahaica berbice",
        "region 6": "east berbice-corentyne",
        "region 7": "cuyuni-mazaruni",
        "region 8": "potaro-siparuni",
        "region 9": "upper takutu-upper essequibo",
        "region 10": "upper demerara-berbice",
        "region 11": "demerara-mahaica",
    },
    (1, "PAN"): {
        "comarca ngabe bugle": "ngobe bugle",
        "comarca ngäbe bugle": "ngobe bugle",
        "comarca guna yala": "kuna yala",
        "comarca embera": "embera",
        "comarca embera-wounaan": "embera",
    },
    (2, "SUR"): {
        "boven sur.": "boven suriname",
        "nw. nickerie": "nieuw nickerie",
        "westelijk pld.": "westelijke polders",
        "saramacca pld.": "saramacca polder",
        "oostelijk pld.": "oostelijke polders",
        "nw. amsterdam": "nieuw amsterdam",
        "brok. centrum": "centrum",
        "koewarasan": "kwarasan",
        "bronsweg": "brownsweg",
        "marchalkreek": "marechallkreek",
        "johanna marie": "johanna maria",
        "nieuwe grond": "de nieuwe grond",
    },
    (2, "ECU"): {
        "ruminahui": "rumiahui",
        "logrono": "logroo",
        "canar": "caar",
        "coronel marcelino mariduena": "crnel. marcelino mariduea",
        "general antonio elizalde": "gnral. antonio elizalde",
    },
}
# coarse raw group -> polygons it covers
ADMIN_GROUPS = {
    (1, "BHS"): {
        "abacos": ("central abaco", "north abaco", "south abaco", "hope town", "moore's island", "grand cay"),
        "andros": ("central andros", "north andros", "south andros", "mangrove cay"),
        "eleuthera": ("central eleuthera", "north eleuthera", "south eleuthera", "harbour island", "spanish wells"),
        "exuma and cays": ("exuma", "black point", "ragged island"),
        "grand bahama": ("city of freeport", "east grand bahama", "west grand bahama"),
        "sweetings cay": ("east grand bahama",),
    },
}

# ---- marts --------------------------------------------------------------------------------
# documented corrections made before the checks: iso -> (reprojected, zero pairs, swapped)
PRE_CORRECTIONS = {
    "COL": (0, 13, 0),
    "URY": (2395, 0, 0),
    "ECU": (14938, 0, 0),
    "GUY": (0, 0, 503),
    "PRY": (0, 0, 7628),
}
HIGH_PRECISION = ("gps_validated", "geocoded_street")
CENTROID_PRECISION = ("geocoded_centroid", "cluster_centroid")
UNVERIFIED = ("gps_unverified", "adm_mismatch", "geocoder_disagrees", "out_of_bounds", "swapped")
VERIFIED_LIKE = ("gps_validated", "geocoded_street", "geocoded_centroid")

"""Text columns: name folding, identifiers, codes and address parts.

Every function takes and returns Column expressions, so the work stays inside
whole-stage code generation.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholder texts that stand for "no value" in address columns.
JUNK_VALUES = (
    "", "nan", "none", "ninguno", "s/n", "sin nombre", "sin direccion",
    "ninguno ninguno 0, ninguno", "no disponible", "no aplica", "s/d",
)
# Door numbers that mean "no number".
NO_NUMBER = ("", "s/n", "sin numero", "sin número", "nan", "none")
# Prefixes of names that describe a type of school.
GENERIC_PREFIXES = (
    "escuela nueva", "escuela rural mixta", "escuela rural", "escuela urbana",
    "escuela", "centro educativo rural", "centro educativo",
    "sede ", "sede principal", "e m e f", "e m e i f", "e m e i",
    "unidad educativa", "nucleo educativo",
)
# Prefixes of names that point to one institution.
NAMED_PREFIXES = (
    "colegio ", "liceo ", "instituto ", "gimnasio ", "seminario ",
    "fundacion ", "corporacion ", "academia ", "politecnico ",
)
# Text spellings of a missing value left by earlier exports.
NULL_WORDS = ("nan", "None", "none")

# Hangul syllables decompose by arithmetic: 19 leads, 21 vowels and 28 tails (one is none).
_LEADS = "".join(chr(0x1100 + i) for i in range(19))
_VOWELS = "".join(chr(0x1161 + i) for i in range(21))
_TAILS = "".join(chr(0x11A8 + i) for i in range(27))


@lru_cache(maxsize=4)
def _fold_table(form: str, ascii_only: bool) -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Single-character table and multi-character pairs, derived from all of Unicode."""
    single, plain, multi = [], [], []
    for point in range(0x80, 0x110000):
        char = chr(point)
        if 0xAC00 <= point <= 0xD7A3 or 0xD800 <= point <= 0xDFFF:
            continue
        parts = unicodedata.normalize(form, char)
        if parts == char:
            continue
        kept = "".join(
            p for p in parts
            if (ord(p) < 128 if ascii_only else not unicodedata.combining(p))
        )
        if kept == char or not kept:
            continue
        if len(kept) == 1:
            single.append(char)
            plain.append(kept)
        else:
            multi.append((char, kept))
    return "".join(single), "".join(plain), tuple(multi)


@lru_cache(maxsize=2)
def _marks(form: str) -> str:
    """Pattern of the characters with a combining class, and of those that decompose into
    nothing else."""
    found = [
        c for c in range(0x80, 0x110000)
        if not 0xD800 <= c <= 0xDFFF and all(unicodedata.combining(p) for p in unicodedata.normalize(form, chr(c)))
    ]
    ranges: list[list[int]] = []
    for c in found:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    marks = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)
    return rf"(?:(?=[^\x00-\x7F])[{marks}])+"  # ASCII, most of a text, is passed over at once


def _spell_hangul(col: Column) -> Column:
    """Syllables as their letters."""

    def spell(char: Column) -> Column:
        at = F.ascii(char) - 0xAC00
        lead = F.substring(F.lit(_LEADS), F.floor(at / 588).cast("int") + 1, F.lit(1))
        vowel = F.substring(F.lit(_VOWELS), F.floor(at % 588 / 28).cast("int") + 1, F.lit(1))
        tail = F.when(at % 28 > 0, F.substring(F.lit(_TAILS), (at % 28).cast("int"), F.lit(1))).otherwise("")
        return F.when(at.between(0, 11171), F.concat(lead, vowel, tail)).otherwise(char)

    return F.array_join(F.transform(F.split(col, ""), spell), "")


def _unaccent(col: Column, form: str, ascii_only: bool) -> Column:
    single, plain, multi = _fold_table(form, ascii_only)
    folded = col
    if multi:
        # ligatures, fractions and the like stand for several letters: only those that the
        # text holds are looked up, among its few characters outside ASCII
        keys, forms = "".join(char for char, _ in multi), F.split(F.lit("\n".join(plain_form for _, plain_form in multi)), "\n")
        strange = F.regexp_replace(col, r"[\x00-\x7F]+", "")
        held = F.array_distinct(F.regexp_extract_all(strange, F.lit(f"[{keys}]"), F.lit(0)))
        folded = F.aggregate(held, col, lambda text, char: F.replace(text, char, F.element_at(forms, F.position(char, F.lit(keys)))))
    folded = F.translate(folded, single, plain)
    # dropping everything outside ASCII drops the marks as well
    folded = F.regexp_replace(folded, r"[^\x00-\x7F]+" if ascii_only else _marks(form), "")
    if not ascii_only:
        folded = F.when(col.rlike("[\uac00-\ud7a3]"), _spell_hangul(folded)).otherwise(folded)
    # plain ASCII text, the common case, skips the table
    return F.when(col.rlike(r"[^\x00-\x7F]"), folded).otherwise(col)


def normalize_name(col: Column) -> Column:
    """Accents and other non-ASCII dropped, lower case, single spaces; null gives ''."""
    text = F.lower(_unaccent(F.coalesce(col.cast("string"), F.lit("")), "NFKD", True))
    return F.trim(F.regexp_replace(text, r"[\s\x1c-\x1f]+", " "))


def fold_name(col: Column) -> Column:
    """Lower case, trimmed, marks and control characters dropped; other letters kept."""
    text = F.lower(F.trim(F.coalesce(col.cast("string"), F.lit(""))))
    return F.regexp_replace(_unaccent(text, "NFKD", False), r"\p{C}+", "")


def fold_admin(col: Column) -> Column:
    """Lower case, trimmed, marks dropped; inner spacing kept."""
    text = F.trim(F.lower(F.coalesce(col.cast("string"), F.lit(""))))
    return _unaccent(text, "NFD", False)


def normalize_id(col: Column) -> Column:
    """Trimmed id text without the '.0' a float export leaves."""
    return F.regexp_replace(F.trim(F.coalesce(col.cast("string"), F.lit(""))), r"\.0$", "")


def integer_id(col: Column) -> Column:
    """Whole-number ids as integer text, any other id trimmed."""
    text = F.trim(col.cast("string"))
    return F.coalesce(text.try_cast("double").try_cast("bigint").cast("string"), text)


def clean_text(col: Column) -> Column:
    """Null, NaN text excluded: null and blanks become ''."""
    return F.coalesce(F.nullif(F.trim(col.cast("string")), F.lit("")), F.lit(""))


def is_blank(col: Column) -> Column:
    return clean_text(col) == ""


def blank_null_words(col: Column) -> Column:
    """Trimmed text with the spellings of a missing value turned into ''."""
    text = clean_text(col)
    return F.when(text.isin(*NULL_WORDS), F.lit("")).otherwise(text)


def blank_junk(col: Column) -> Column:
    """Trimmed text, '' when it is a placeholder."""
    text = clean_text(col)
    return F.when(F.lower(text).isin(*JUNK_VALUES), F.lit("")).otherwise(text)


def fix_mojibake(col: Column) -> Column:
    """Repair UTF-8 text that was read as Latin-1; text that is not such stays as it is."""
    suspect = col.contains("Ã") & ~col.rlike(r"[^\x00-\xFF]")
    data = F.encode(F.when(suspect, col), "ISO-8859-1")
    repaired = F.try_validate_utf8(data.cast("string"))
    return F.when(suspect, F.coalesce(repaired, col)).otherwise(col)


def extract(col: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, null when the pattern does not occur."""
    text = col.cast("string")
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def composite_id(*parts: Column) -> Column:
    return F.concat_ws("-", *[p.cast("string") for p in parts])


def numbered_id(prefix: str, number: Column, width: int) -> Column:
    """Prefix and zero-padded number, e.g. BHS-007."""
    return F.format_string(f"{prefix}%0{width}d", number.cast("bigint"))


def admin_code(col: Column, prefix: str, width: int) -> Column:
    """Numeric raw code in the boundary scheme, e.g. AR006; not a number gives ''."""
    number = F.trim(col.cast("string")).try_cast("double").try_cast("bigint")
    return F.when(number.isNull(), F.lit("")).otherwise(numbered_id(prefix, number, width))


def compose_street(street: Column, door: Column) -> Column:
    """Street with its door number, unless the number says there is none."""
    name, number = clean_text(street), clean_text(door)
    has_number = ~F.lower(number).isin(*NO_NUMBER)
    return F.when(has_number, F.concat(name, F.lit(" "), number)).otherwise(name)


def is_specific_name(col: Column) -> Column:
    """Whether a school name points to one institution rather than to a type."""
    text = F.coalesce(col.cast("string"), F.lit(""))
    name = F.trim(F.lower(text))
    named, generic = F.lit(False), F.lit(False)
    for prefix in NAMED_PREFIXES:
        named = named | (name.startswith(prefix) & (F.length(name) > len(prefix) + 3))
    for prefix in GENERIC_PREFIXES:
        generic = generic | name.startswith(prefix)
    long_institution = (
        (name.contains("institucion educativa") | name.contains("institución educativa"))
        & (F.length(name) > 30)
    )
    return (
        F.when(F.length(text) < 8, False)
        .when(named, True)
        .when(generic, False)
        .otherwise(long_institution)
    )


def address_queries(
    street: Column, name: Column, locality: Column, adm2: Column, adm1: Column, country: Column
) -> Column:
    """Array of (ord, precision, query) from the most to the least specific."""
    street, name, locality = blank_junk(street), blank_junk(name), blank_junk(locality)
    adm2, adm1 = blank_junk(adm2), blank_junk(adm1)
    placed = (adm2 != "") & (adm1 != "")
    tail = F.concat_ws(", ", adm2, adm1, country)
    steps = (
        ("street", placed & (street != ""), F.concat_ws(", ", street, tail)),
        ("school_name", placed & (name != "") & is_specific_name(name), F.concat_ws(", ", name, tail)),
        ("locality", placed & (locality != ""), F.concat_ws(", ", locality, tail)),
        ("admin", placed, tail),
    )
    items = [
        F.when(
            cond,
            F.struct(F.lit(i).alias("ord"), F.lit(label).alias("precision"), text.alias("query")),
        )
        for i, (label, cond, text) in enumerate(steps)
    ]
    return F.filter(F.array(*items), lambda q: q.isNotNull())


def any_of(col: Column, pattern: str) -> Column:
    """Case-insensitive regular expression test; null text counts as no match."""
    return F.coalesce(col.cast("string").rlike(f"(?i){pattern}"), F.lit(False))


def fuzzy_column(columns: list[str], wanted: str | None) -> str | None:
    """Header lookup: exact first, then equal after folding; None when absent."""
    if wanted is None:
        return None
    if wanted in columns:
        return wanted

    def fold(header: str) -> str:
        parts = unicodedata.normalize("NFKD", header.strip().lower())
        return "".join(
            c for c in parts if not unicodedata.combining(c) and unicodedata.category(c)[0] != "C"
        )

    return next((c for c in columns if fold(c) == fold(wanted)), None)

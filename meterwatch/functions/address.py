"""Address text as pure column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: what the two address formats abbreviate
ABBREVIATIONS_A = {"CLL": "CALLE", "AVE": "AVENIDA", "MNZ": "MANZANA", "LTE": "LOTE"}
ABBREVIATIONS_B = {
    "K": "CARRERA", "CR": "CARRERA", "CL": "CALLE", "AV": "AVENIDA",
    "TR": "TRANSVERSAL", "VD": "VEREDA",
}
CUT_WORDS_B = ("APTO", "APARTAMENTO", "LC", "BLOQUE", "INTERIOR", "CASA")
DROP_WORDS_B = ("MACROMEDICION", "MACRO")
# fixed values: cleaning patterns of the two formats, with what takes the place of a match
CLEANING_A = ((r"\([^)]*\)", ""), (r"\s+(CAS\s|APT\s|LOC\s).*$", ""))
CLEANING_B = ((r"\b0+(\d+)\b", "$1"), (r"\s+0000\s*$", ""))
STREET_B = (r"((?:CARRERA|CALLE|AVENIDA|DIAGONAL|TRANSVERSAL)\s+\w+(?:\s+[A-Z]+)*)\s+(\d+\s*[A-Z]?\s*-\s*\d+)", "$1 # $2")
DEFAULT_REGION, DEFAULT_COUNTRY = "NORTE DE SANTANDER", "COLOMBIA"
DEFAULT_CITY_B, DEFAULT_COUNTRY_B = "Cali", "Colombia"

# fixed values: address shapes in order of precedence, with the text built from the groups
SHAPES_A = (
    (r"\b([A-ZÁÉÍÓÚÑ]+)\s+(\d+[A-Z]{0,2})\s+(\d+[A-Z]{0,2})\s*-\s*(\d+)", "{1} {2} #{3}-{4}"),
    (r"\b(CALLE|AVENIDA|MANZANA|LOTE)\s+(\d+[A-Z]{0,2})\s+(\d+[A-Z]{0,2})\s+(\d+)", "{1} {2} #{3}-{4}"),
    (r"\bAVENIDA CANAL BOGOTA\s+(\d+)\s+(\d+)\b", "AVENIDA CANAL BOGOTA #{1}-{2}"),
    (r"\b(CALLE \d+ NORTE)\s+(\d+[A-Z]?)\s*-\s*(\d+)\b", "{1} #{2}-{3}"),
    (r"\bCRR ANT BELEN\s+(\d+[A-Z]?)\s*-\s*(\d+)\b", "CARRERA ANTIGUA BELEN #{1}-{2}"),
    (r"\bAVENIDA CANAL BOGOTA\s+(\d+[A-Z]?)\s+(\d+)\b", "AVENIDA CANAL BOGOTA #{1}-{2}"),
    (r"\b(AVENIDA LIBERTADORES)\s+(\d+[A-Z]?)\s*-\s*(\d+)\b", "{1} #{2}-{3}"),
    (r"\bCRR BELEN\s+(\d+[A-Z]?)\s+(\d+)\b", "CARRERA BELEN #{1}-{2}"),
)


UNICODE = "(?U)"  # letters such as Ñ count as word characters


def _swap(text: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(text, UNICODE + pattern, by)


def _strip(text: Column) -> Column:
    return _swap(text, r"^\s+|\s+$", "")


def _squeeze(text: Column) -> Column:
    return F.trim(_swap(text, r"\s+", " "))


def _expand(text: Column, words: dict[str, str]) -> Column:
    for short, full in words.items():
        text = _swap(text, rf"\b{short}\b", full)
    return text


def _from_groups(text: Column, pattern: str, template: str) -> Column:
    parts: list[Column] = []
    rest = template
    while "{" in rest:
        plain, _, tail = rest.partition("{")
        number, _, rest = tail.partition("}")
        if plain:
            parts.append(F.lit(plain))
        parts.append(F.regexp_extract(text, UNICODE + pattern, int(number)))
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)


def standardise_a(address: Column) -> Column:
    """Rebuild the first known address shape; otherwise the cleaned text."""
    text = F.upper(address)
    for pattern, by in CLEANING_A:
        text = _swap(text, pattern, by)
    text = _squeeze(_expand(text, ABBREVIATIONS_A))
    result: Column | None = None
    for pattern, template in SHAPES_A:
        built = _from_groups(text, pattern, template)
        test = text.rlike(UNICODE + pattern)
        result = F.when(test, built) if result is None else result.when(test, built)
    return result.otherwise(text)


def label_a(
    standard: Column, quarter: Column, town: Column,
    region: str = DEFAULT_REGION, country: str = DEFAULT_COUNTRY,
) -> Column:
    """``address, quarter, Town, REGION, COUNTRY``; NULL if a part is NULL."""
    return F.concat(standard, F.lit(", "), quarter, F.lit(", "), F.initcap(town),
                    F.lit(f", {region}, {country}"))


def normalise_b(address: Column, city: str = DEFAULT_CITY_B, country: str = DEFAULT_COUNTRY_B) -> Column:
    """Cut, expand and punctuate an address of the second format."""
    text = _strip(F.upper(address))
    for word in CUT_WORDS_B:
        text = _strip(F.substring_index(text, word, 1))
    for word in DROP_WORDS_B:
        text = F.replace(text, F.lit(word), F.lit(""))
    text = _expand(_strip(text), ABBREVIATIONS_B)
    for pattern, by in CLEANING_B:
        text = _swap(text, pattern, by)
    text = _swap(_squeeze(text), *STREET_B)
    return F.concat(text, F.lit(f", {city}, {country}"))


def with_fallback(official: Column, installed: Column, city: str = DEFAULT_CITY_B) -> tuple[Column, Column]:
    """(address, source): official, else installation, else failed.

    A text is cleaned to NULL only if it is NULL, so the source needs no cleaning.
    """
    # fixed values: names of the sources
    source = (F.when(official.isNotNull(), "direccion_oficial")
              .when(installed.isNotNull(), "instalacion").otherwise("fallido"))
    return F.coalesce(normalise_b(official, city), normalise_b(installed, city)), source

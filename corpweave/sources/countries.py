"""Country dimension: every spelling a country is known by, with its short name and two-letter code."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.functions.text import normalise_keyword, soft_string, strip

COUNTRY_SCHEMA = "alias string, country string, iso2 string"
MIN_COUNTRY_LENGTH = 3

# Everyday and official names the locale data does not list, by two-letter code.
EXTRA_ALIASES = {
    "AE": ["uae", "emirates"],
    "BO": ["bolivia (plurinational state of)"],
    "CD": ["democratic republic of the congo", "dr congo", "drc"],
    "CG": ["congo", "republic of the congo", "republic of congo", "congo republic"],
    "CI": ["ivory coast"],
    "CN": ["people's republic of china", "prc"],
    "CV": ["cabo verde"],
    "CZ": ["czech republic"],
    "FR": ["french republic"],
    "DE": ["federal republic of germany", "deutschland"],
    "FM": ["federated states of micronesia"],
    "GB": ["great britain", "britain", "england", "scotland", "wales", "northern ireland"],
    "HK": ["hong kong"],
    "IR": ["islamic republic of iran"],
    "KP": ["dprk"],
    "KR": ["republic of korea", "korea, republic of", "korea"],
    "LA": ["lao pdr"],
    "MK": ["macedonia"],
    "MM": ["burma", "myanmar"],
    "MO": ["macau", "macao"],
    "NL": ["holland", "the netherlands"],
    "PS": ["palestine", "state of palestine"],
    "RU": ["russian federation"],
    "SY": ["syrian arab republic"],
    "SZ": ["swaziland"],
    "TR": ["turkey", "turkiye"],
    "TW": ["chinese taipei"],
    "TZ": ["united republic of tanzania"],
    "US": ["united states of america", "u.s.a.", "u.s.", "the united states", "america"],
    "VN": ["viet nam"],
}


# The words official names put before a short name.
STYLES = ("republic of", "the republic of", "kingdom of", "islamic republic of", "state of", "commonwealth of", "principality of")


def spellings(name: str) -> set[str]:
    """A name with "and" for "&", "saint" for "st.", and without what stands in brackets or after a hyphen's blanks."""
    plain = folded(name)
    short = re.sub(r" sar china$|\s*\(.*\)", "", plain).strip()
    forms = {plain, short}
    forms |= {f.replace("&", "and") for f in forms}
    forms |= {re.sub(r"\bst\.? ", "saint ", f) for f in forms} | {re.sub(r"\bst\.? ", "st ", f) for f in forms}
    return forms


def folded(name: str) -> str:
    """Lower case without accents, with straight apostrophes, as :func:`country_alias` spells."""
    letters = unicodedata.normalize("NFD", name.casefold().replace("\u2019", "'"))
    return "".join(c for c in letters if not unicodedata.combining(c)).replace("\u00f8", "o").replace("\u0142", "l")


def country_rows(names: list[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    """(alias, country, iso2) of (name, iso2, iso3): plain spellings first, then official styles nobody else uses."""
    rows: dict[str, tuple[str, str]] = {}
    for name, code, code3 in names:
        for alias in [*map(folded, EXTRA_ALIASES.get(code, [])), code.lower(), code3.lower()]:
            rows[alias] = (name, code)
    for name, code, _ in names:
        for alias in spellings(name):
            rows.setdefault(alias, (name, code))
    styled: dict[str, set[tuple[str, str]]] = {}
    for name, code, _ in names:
        for short in spellings(name):
            for style in STYLES:
                for alias in (f"{style} {short}", f"{short}, {style}"):
                    styled.setdefault(alias, set()).add((name, code))
    for alias, owners in styled.items():
        if len(owners) == 1:
            rows.setdefault(alias, next(iter(owners)))
    return sorted((alias, *owner) for alias, owner in rows.items())


def builtin_countries(spark: SparkSession) -> DataFrame:
    """A dimension built from the JVM's own ISO country list: spellings, both ISO codes and the extra aliases.

    Its size is fixed by that list (some thousand short rows), so it is broadcast and the big side never moves.
    """
    locale = spark._jvm.java.util.Locale
    places = [(code, locale("", code)) for code in locale.getISOCountries()]
    names = [(place.getDisplayCountry(locale.ENGLISH), code, place.getISO3Country()) for code, place in places]
    return F.broadcast(spark.createDataFrame(country_rows(names), COUNTRY_SCHEMA))


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    """A dimension of your own from a CSV file with the columns alias, country, iso2."""
    return (
        spark.read.schema(COUNTRY_SCHEMA)
        .option("header", True)
        .csv(path)
        .withColumn("alias", normalise_keyword(strip(F.col("alias"))))
        .dropDuplicates(["alias"])
    )


def country_alias(c: Column) -> Column:
    """The spelling to look up: soft text of at least three characters, lower case."""
    return normalise_keyword(F.replace(soft_string(c, min_length=MIN_COUNTRY_LENGTH), F.lit("\u2019"), F.lit("'")))


def lookup_country(df: DataFrame, column: str, countries: DataFrame) -> DataFrame:
    """Add ``country_name`` and ``iso2`` for a free-text country column; unknown gives null in both.

    A dimension of your own carries no broadcast hint: Spark broadcasts it while its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and splits skewed partitions of a shuffled join otherwise.
    """
    dimension = countries.select(
        F.col("alias").alias("_alias"),
        F.col("country").alias("country_name"),
        F.when(F.col("iso2").rlike("^[A-Za-z]{2}$"), F.upper("iso2")).alias("iso2"),
    )
    return df.withColumn("_alias", country_alias(F.col(column))).join(dimension, "_alias", "left").drop("_alias")

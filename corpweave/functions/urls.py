"""URL normalisation as a native expression.

Escapes of characters that need none are decoded and blanks are escaped, so spellings of one URL agree. Plus signs,
user info, path parameters and non-ASCII characters are kept as written.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpweave.functions.text import strip

SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*://"
HOST_WITHOUT_PATH = rf"^({SCHEME}[^/?]*)\?"
# A scheme with the www. after it (any case, as hosts ignore case), or a bare lower-case www.
PREFIX = rf"^(?:{SCHEME}(?i:www\.)?|www\.)"
PARTITION_PREFIX_LENGTH = 5


# The escapes, without their percent sign, of letters, digits and - . _ ~
UNRESERVED = "^(2[DdEe]|3[0-9]|4[1-9A-Fa-f]|5[0-9AaFf]|6[1-9A-Fa-f]|7[0-9AaEe])"


def canonical_escapes(c: Column) -> Column:
    """Blanks as ``%20``, and characters that need no escape without one."""
    parts = F.split(F.replace(c, F.lit(" "), F.lit("%20")), "%", -1)

    def decoded(part: Column) -> Column:
        character = F.char(F.conv(F.substring(part, 1, 2), 16, 10).cast("bigint"))
        plain = F.concat(character, F.substring(part, 3, 1 << 30))
        return F.when(part.rlike(UNRESERVED), plain).otherwise(F.concat(F.lit("%"), part))

    rest = F.transform(F.slice(parts, 2, 1 << 30), decoded)
    return F.when(c.rlike("[% ]"), F.concat(F.element_at(parts, 1), F.array_join(rest, ""))).otherwise(c)


def _sorted_query(query: Column) -> Column:
    """Query arguments as ``key=value``, sorted by key then value; an argument without ``=`` gets one."""
    arguments = F.filter(F.split(query, "&"), lambda a: a != "")
    pairs = F.transform(
        arguments,
        lambda a: F.struct(
            F.substring_index(a, "=", 1).alias("key"), F.regexp_replace(a, "^[^=]*=?", "").alias("value")
        ),
    )
    return F.array_join(F.transform(F.array_sort(pairs), lambda p: F.concat(p["key"], F.lit("="), p["value"])), "&")


def normalise_url(c: Column) -> Column:
    """Scheme, fragment, trailing slashes and a leading ``www.`` removed, arguments sorted, lower case.

    The host is case-insensitive only where a scheme marks it as a host, so ``WWW.x.ai`` without a scheme
    keeps its prefix.
    """
    without_fragment = F.regexp_replace(canonical_escapes(strip(c)), "(?s)#.*$", "")
    rooted = F.regexp_replace(without_fragment, HOST_WITHOUT_PATH, "$1/?")
    body = F.regexp_replace(rooted, PREFIX, "")
    query = _sorted_query(F.regexp_replace(body, r"(?s)^[^?]*\??", ""))
    whole = F.concat(F.substring_index(body, "?", 1), F.lit("?"), query)
    return F.lower(F.rtrim(F.regexp_replace(whole, r"(?s)^([^?]*)\?$", "$1"), F.lit("/")))


def url_partition_key(normalised: Column) -> Column:
    """First five characters of the normalised URL; null when there is none."""
    return F.when(normalised != "", F.substring(normalised, 1, PARTITION_PREFIX_LENGTH))


def url_bucket(normalised: Column, buckets: int) -> Column:
    """Evenly spread bucket number: the partition key to use on large tables, where prefixes are skewed."""
    return F.pmod(F.xxhash64(normalised), F.lit(buckets)).cast("int")

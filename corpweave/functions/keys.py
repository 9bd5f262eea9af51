"""Hub keys and change hashes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpweave.functions.text import strip

# Fixed values of the hashing convention.
NULL_TOKEN = "^~"
NULL_KEY = "~~NULL~~"
SEPARATOR = "||"
OID_NAMESPACE = "6ba7b8129dad11d180b400c04fd430c8"  # RFC 4122 namespace for object identifiers
ZERO_UUID = "00000000-0000-0000-0000-000000000000"


def std(c: Column) -> Column:
    """Trimmed upper-case text; null and blank become one token."""
    text = F.upper(strip(c.cast("string")))
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(NULL_TOKEN))


def key_hash(c: Column) -> Column:
    """SHA-256 of a single business key."""
    return F.sha2(std(F.coalesce(c.cast("string"), F.lit(NULL_KEY))), 256)


def _as_text(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column).cast("string")  # the same in every session time zone
    nested = isinstance(data_type, (T.ArrayType, T.MapType, T.StructType))
    return F.to_json(column) if nested else column.cast("string")


def payload_hash(df: DataFrame, columns: Iterable[str]) -> Column:
    """SHA-256 over the named columns in name order; lists and structs take part as JSON."""
    types = {field.name: field.dataType for field in df.schema.fields}
    parts = [std(_as_text(F.col(name), types[name])) for name in sorted(columns)]
    return F.sha2(std(F.concat_ws(SEPARATOR, *parts)), 256)


def with_hdiff(df: DataFrame, exclude: Iterable[str], name: str = "hdiff") -> DataFrame:
    """Add the change hash over every column except the excluded ones (keys and load times)."""
    left_out = set(exclude) | {name}
    return df.withColumn(name, payload_hash(df, [c for c in df.columns if c not in left_out]))


def uuid5(c: Column) -> Column:
    """Name-based UUID (version 5) in the object-identifier namespace; blank gives the zero UUID."""
    name = strip(c)
    digest = F.sha1(F.concat(F.unhex(F.lit(OID_NAMESPACE)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    text = F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )
    return F.when(F.coalesce(name, F.lit("")) == "", F.lit(ZERO_UUID)).otherwise(text)


def hub_key(source_id: Column, source_name: str) -> Column:
    """Deterministic key of a business identifier within one source. A missing identifier raises."""
    if not source_name:
        raise ValueError("hub_key needs a source name")
    present = F.when(
        F.coalesce(source_id, F.lit("")) == "", F.raise_error(F.lit("hub_key: missing source id")).cast("string")
    ).otherwise(source_id)
    return uuid5(F.concat(std(present), F.lit(SEPARATOR), std(F.lit(source_name))))

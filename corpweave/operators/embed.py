"""Turning text columns into vectors inside Spark tasks, with an encoder of your choice."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpweave.functions.text import global_text, joined, tokenise
from corpweave.specs import DEFAULT_DIM

_WORD = re.compile(r"[^\W_]+")

EMBED_FIELDS = ["description_long", "description_short", "product_services", "market_niches", "business_model"]


class HashingEncoder:
    """Hashing-trick encoder: signed word counts in ``dim`` slots, scaled to length one.

    Shows what a plugged-in model looks like; :func:`hashed_vectors` does the like without Python. Any callable from a list of texts to a two-dimensional array works
    in its place; it is built once per Python worker.
    """

    def __init__(self, dim: int = DEFAULT_DIM, seed: int = 0) -> None:
        self.dim = dim
        self.seed = seed

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim))
        for row, text in enumerate(texts):
            hashes = np.array([zlib.crc32(w.encode(), self.seed) for w in _WORD.findall(text.lower())], dtype=np.int64)
            if hashes.size:
                np.add.at(out[row], (hashes >> 1) % self.dim, np.where(hashes & 1, 1.0, -1.0))
        lengths = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, lengths, out=out, where=lengths > 0)


def hashed_vectors(df: DataFrame, key: str, texts: dict[str, Column], dim: int = DEFAULT_DIM) -> DataFrame:
    """Key and one ``embedding_<field>`` vector per text column, by the hashing trick.

    A word's MD5 digest gives its slot (first six hex digits modulo ``dim``) and its sign (last digit); the signed
    counts of a text are scaled to length one. Text without words gives zeros, null or empty text gives null.
    Rows stay where they are: Spark turns words into signed slots, and a task counts those of one Arrow batch at a time, so
    nothing is shuffled and what a task holds does not grow with its rows.
    """
    names = list(texts)

    def signed_slot(word: Column) -> Column:
        digest = F.md5(word)
        slot = (F.conv(F.substring(digest, 1, 6), 16, 10).cast("bigint") % dim).cast("int") + 1
        return F.when(F.substring(digest, 32, 1) < "8", slot).otherwise(-slot)

    slots = [F.transform(tokenise(F.nullif(c, F.lit(""))), signed_slot).alias(name) for name, c in texts.items()]
    schema = T.StructType(
        [df.schema[key], *[T.StructField(f"embedding_{name}", T.ArrayType(T.DoubleType())) for name in names]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [slot_vectors(batch.column(i + 1), dim) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *vectors], names=schema.names)

    return df.select(key, *slots).mapInArrow(run, schema)


def slot_vectors(slots: pa.Array, dim: int) -> pa.Array:
    """Lists of signed slots, counted from 1, as vectors of length one; null stays null, no slots give zeros."""
    row = np.repeat(np.arange(len(slots)), slots.value_lengths().fill_null(0).to_numpy())
    signed = slots.flatten().to_numpy()
    counts = np.bincount(row * dim + np.abs(signed) - 1, np.sign(signed), len(slots) * dim).astype(float).reshape(-1, dim)
    lengths = np.sqrt((counts * counts).sum(1, keepdims=True))
    np.divide(counts, lengths, out=counts, where=lengths > 0)
    absent = slots.is_null()
    kept = counts[~absent.to_numpy(zero_copy_only=False)].ravel()
    # a null offset marks a list as null
    ends = np.r_[0, np.cumsum(np.where(absent.to_numpy(zero_copy_only=False), 0, dim))].astype(np.int32)
    offsets = pa.array(ends, mask=np.r_[absent.to_numpy(zero_copy_only=False), False])
    return pa.ListArray.from_arrays(offsets, pa.array(kept))


def embedding_texts(df: DataFrame, fields: list[str] | None = None) -> dict[str, Column]:
    """Text to embed per field (lists joined by `` | ``), plus all of it as the global text."""
    names = [c for c in (fields or EMBED_FIELDS) if c in df.columns]
    lists = {c for c in names if isinstance(df.schema[c].dataType, T.ArrayType)}
    texts = {c: joined(F.col(c)) if c in lists else F.col(c) for c in names}
    return {**texts, "global_vector": global_text(*texts.values())}


def embed_columns(
    df: DataFrame,
    key: str,
    texts: dict[str, Column],
    make_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
    dim: int = DEFAULT_DIM,
) -> DataFrame:
    """Key and one ``embedding_<field>`` vector per text column; null or empty text gives null.

    Texts travel to the Python workers in Arrow batches. A vector of another size than ``dim`` is an error of
    the encoder and raises.
    """
    names = list(texts)
    key_type = df.schema[key].dataType
    vector = T.ArrayType(T.DoubleType())
    schema = T.StructType(
        [T.StructField(key, key_type), *[T.StructField(f"embedding_{name}", vector) for name in names]]
    )

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = make_encoder()
        for batch in batches:
            result = {key: batch[key]}
            for name in names:
                present = batch[name].notna() & (batch[name] != "")
                vectors = pd.Series([None] * len(batch), index=batch.index, dtype=object)
                if present.any():
                    encoded = np.asarray(encoder(batch.loc[present, name].tolist()), dtype=float)
                    if encoded.shape[1] != dim:
                        raise ValueError(f"encoder gave {encoded.shape[1]} dimensions, wanted {dim}")
                    vectors.loc[present] = list(encoded)
                result[f"embedding_{name}"] = vectors
            yield pd.DataFrame(result)

    return df.select(key, *[c.alias(name) for name, c in texts.items()]).mapInPandas(encode, schema)

"""Toxicity by compression distance: two zstandard dictionaries, window lengths compared, thresholds calibrated.

A text is lower-cased, split into words, and cut into windows of ``WINDOW_WORDS`` words. Each window is compressed
twice, behind the ordinary dictionary alone and behind the same dictionary followed by the toxic one (with as many
bytes of further ordinary words on the other side). The difference in compressed length is the window's distance.

Training, on a bounded sample of labelled rows:

* The ordinary dictionary is trained by zstandard's cover algorithm on windows of ordinary texts.
* The toxic dictionary starts as one trained on windows of toxic texts and is sharpened in rounds. Toxic texts are
  mostly ordinary prose, so each round keeps the windows whose distance exceeds what three ordinary windows in a thousand
  reach, and in these the word without which the distance falls most. Words found in ``SUPPORT`` windows form the
  next dictionary, the most frequent last, where offsets are cheapest. Texts are split in two folds by content, and
  each fold is judged by the other's dictionary, so that a text never vouches for itself. Windows that several texts
  share say nothing about either class and are left out.
* Distances of 1 to 6 bytes are thresholds; each is calibrated by how often ordinary windows reach it. A document's
  evidence is how far its counts exceed these rates, with its largest distances; a logistic regression turns that
  into the probability of label 1.

Only the text enters a score. Bounds: at most ``MAX_TOXIC`` and ``MAX_ORDINARY`` labelled texts of at most
``MAX_CHARS`` characters reach the driver, chosen by a hash of the id; the model is about 150 kB and travels with
the tasks. Scoring is one pass over whole texts without a shuffle.

Cases: null and empty texts get the score of a text without evidence; without labels of both classes every score is
the share of toxic labels (0 without labels); repeated rows score alike; null labels are not learned from.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.llm.common import arrow_map, arrow_schema, text_or_empty, to_batch

WINDOW_WORDS = 10
ORDINARY_BYTES, TOXIC_BYTES = 65_536, 6_000
LEVEL, MIN_MATCH = 9, 4
ROUNDS, SUPPORT, RARE = 5, 3, 0.003
STEPS = range(1, 7)
MAX_TOXIC, MAX_ORDINARY, MAX_CHARS = 3_000, 9_000, 50_000
#: Windows that set the ordinary dictionary and the rate at which ordinary text reaches a distance.
COVER_WINDOWS, RATE_WINDOWS = 60_000, 30_000
PREDICT_AT = 0.3


def windows(text: str) -> list[bytes]:
    words = text.encode().lower().split()
    return [b" " + b" ".join(words[i : i + WINDOW_WORDS]) for i in range(0, len(words), WINDOW_WORDS)]


@lru_cache(maxsize=16)
def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """A compressor behind raw dictionary content, for inputs of window size."""
    options = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, dict_size=len(content), source_size=64, write_content_size=0, write_checksum=0, write_dict_id=0,
        min_match=MIN_MATCH, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    trained = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    trained.precompute_compress(compression_params=options)
    return zstandard.ZstdCompressor(dict_data=trained, compression_params=options)


def cover(samples: list[bytes], size: int, segment: int) -> bytes:
    """zstandard's trained dictionary of about ``size`` bytes; small samples are taken as they are."""
    if sum(map(len, samples)) <= 4 * size:
        return b" ".join(samples)[:size]
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()
    except zstandard.ZstdError:  # too uniform to train on
        return b" ".join(samples)[:size]


def distances(ordinary: bytes, toxic: bytes, pieces: list[bytes]) -> np.ndarray:
    plain, other = compressor(ordinary).compress, compressor(toxic).compress
    return np.fromiter((len(plain(p)) - len(other(p)) for p in pieces), np.int32, len(pieces))


@dataclass(frozen=True)
class ToxicityModel:
    """Two dictionaries, the calibrated rates of each distance, and the weights of the evidence."""

    ordinary: bytes
    toxic: bytes
    rates: tuple[float, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    weights: tuple[float, ...]
    constant: float | None = None

    def evidence(self, text: str) -> list[float]:
        pieces = windows(text)
        if not pieces:
            return [0.0] * (len(self.rates) + 3)
        d, n = distances(self.ordinary, self.toxic, pieces), len(pieces)
        counts = [int((d >= k).sum()) for k in STEPS]
        excess = [(c - n * p) / (n * p * (1 - p) + 0.25) ** 0.5 for c, p in zip(counts, self.rates, strict=True)]
        top = np.sort(d)[-2:]
        return [*excess, min(float(d.max()), 8.0), float(top.sum()) / 2, float(np.log(n))]

    def score(self, text: str) -> float:
        if self.constant is not None:
            return self.constant
        x = (np.array(self.evidence(text)) - self.means) / self.scales
        z = float(self.weights[0] + np.clip(x, -4, 4) @ np.array(self.weights[1:]))
        return 1 / (1 + np.exp(-z)) if z > -700 else 0.0


def train(samples: list[tuple[str, int]]) -> ToxicityModel:
    """A model from texts with labels 0 and 1, in any order."""
    samples = sorted(samples)
    toxic = [t for t, y in samples if y]
    ordinary = [t for t, y in samples if not y]
    if not toxic or not ordinary:
        share = len(toxic) / len(samples) if samples else 0.0
        return ToxicityModel(b"", b"", (), (), (), (), constant=share)
    shared = Counter(w for t, _ in samples for w in set(windows(t)))
    alone = lambda texts: [w for t in texts for w in windows(t) if shared[w] == 1 and len(w) > 8]
    pool = sorted(alone(ordinary) or [w for t in ordinary for w in windows(t)] or [b" "], key=zlib.crc32)
    split = min(COVER_WINDOWS, len(pool) // 2 + 1)
    base = cover(pool[:split], ORDINARY_BYTES, 32)
    held = pool[split : split + RATE_WINDOWS] or pool[-RATE_WINDOWS:]
    spare = b" ".join(dict.fromkeys(x for w in pool[split + RATE_WINDOWS :][:20_000] or held for x in w.split()))
    folds = [alone(t for t in toxic if zlib.crc32(t.encode()) % 2 == f) for f in (0, 1)]
    found: list[list[bytes]] = []
    for _ in range(ROUNDS):
        contents = [as_dictionary(f) for f in found] if found else [cover(f, 4 * TOXIC_BYTES, 16) for f in folds]
        found = [
            telling_words(base + spare[: len(contents[1 - f])], base + contents[1 - f], held, folds[f]) for f in (0, 1)
        ]
    content = as_dictionary(found[0] + found[1])
    pair = (base + spare[: len(content)], base + content)
    d = distances(*pair, held)
    rates = tuple(min(0.5, max(float((d >= k).mean()), 1e-5)) for k in STEPS)
    draft = ToxicityModel(*pair, rates, (), (), ())
    x = np.array([draft.evidence(t) for t, _ in samples])
    means, scales, weights = logistic(x, np.array([y for _, y in samples], float))
    return ToxicityModel(*pair, rates, tuple(means), tuple(scales), tuple(weights))


def telling_words(plain: bytes, toxic: bytes, held: list[bytes], pieces: list[bytes]) -> list[bytes]:
    """Of each window far beyond ordinary ones, the word without which its distance falls most."""
    if not pieces:
        return []
    least = max(2.0, float(np.quantile(distances(plain, toxic, held), 1 - RARE)))
    out = []
    for piece, far in zip(pieces, distances(plain, toxic, pieces).tolist(), strict=True):
        if far >= least:
            words = piece.split()
            without = [b" " + b" ".join(words[:i] + words[i + 1 :]) for i in range(len(words))]
            fall = far - distances(plain, toxic, without)
            if fall.max() >= 2:
                out.append(words[int(fall.argmax())].strip(b".,!?;:"))
    return out


def as_dictionary(words: list[bytes]) -> bytes:
    counts = sorted((n, w) for w, n in Counter(words).items() if n >= SUPPORT)
    return b" ".join(w for _, w in counts)[-TOXIC_BYTES:]


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, scales and weights (intercept first) of a ridge logistic regression, by Newton steps."""
    means, scales = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), np.clip((x - means) / scales, -4, 4)])
    w, ridge = np.zeros(z.shape[1]), penalty * np.eye(z.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
    return means, scales, w


def held_out(key: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def train_from(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> ToxicityModel:
    """A model from the labelled rows that are not held out; the sample is bounded by the constants above."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select("doc_id", F.col(label).cast("int").alias("y"))
    some = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for y, most in ((1, MAX_TOXIC), (0, MAX_ORDINARY))]
    # at most MAX_TOXIC + MAX_ORDINARY pairs of numbers go to the tasks, and only their texts come back
    chosen = F.broadcast(some[0].unionAll(some[1]))
    fit = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= MAX_CHARS))
    rows = fit.join(chosen, "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    samples = [(r["text"], r["y"]) for r in rows.select("text", "y").collect()]
    return train(samples)


def score_texts(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the score of every whole text."""
    schema = arrow_schema("doc_id:int64 score:double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, model.score(t)) for i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield to_batch(rows, schema)

    given = docs.select(docs[key].cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    return arrow_map(given, run, "doc_id:int64 score:double").withColumnRenamed("doc_id", key)


def without_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The rows whose text scores below ``PREDICT_AT``, columns as they were."""

    @F.pandas_udf("boolean")
    def clean(texts):  # noqa: ANN001, ANN202
        return texts.map(lambda t: model.score(t or "") < PREDICT_AT)

    return docs.where(clean(F.col(text)))

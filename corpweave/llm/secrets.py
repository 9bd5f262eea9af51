"""Secret scans: fixed patterns, and sliding windows of high Shannon entropy inside candidate strings.

Patterns give ``assign``, ``access`` and ``hex`` spans. The entropy scan looks at candidate strings, maximal runs of
key-like characters, and slides a window over each: the window's character counts, and with them the sum of
``c log2 c``, are updated by the one character that enters and the one that leaves. A window counts when its entropy
reaches the threshold of the narrowest character class that holds all of it (digits, lower-case hexadecimal, letters
of one case with digits, base64) and when it mixes kinds of characters as keys do; separators are neutral in strings that
have a key-like group. The span of kind ``entropy`` is the whole candidate around such windows, after a name and ``=``. The allow-list suppresses entropy spans alone: identifiers and addresses in common public
forms, and strings without a digit or of one case without digits, which are words.

Everything happens row by row where the text is read; no shuffle. Spans are in code points, ends exclusive.

Cases: null text counts as empty; empty texts have no spans; null or repeated ids pass through row by row; very long
texts are scanned whole, in time linear in their length; spans of different kinds may overlap, those of one kind do not.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.llm.common import arrow_map, arrow_schema, text_or_empty, to_batch

KINDS = ("assign", "access", "hex", "entropy")
BASE_KINDS = KINDS[:3]
Span = tuple[int, int, str]

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_WORDS = ("passw", "secret", "token", "api_key", "apikey")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
#: A run of ``[0-9a-f]+`` is kept from 24 characters on; the run's start is the leftmost place where 24 fit.
HEX = re.compile(r"[0-9a-f]{24,}")

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Bits per character a window must reach, by the narrowest class that holds all its characters.
THRESHOLDS = {"digits": None, "hex": 3.0, "alnum": 3.3, "base64": 3.7}
HEX_CHARS = frozenset("0123456789abcdef")
#: c log2 c for the counts a window can have.
CLOGC = [0.0] + [c * log2(c) for c in range(1, WINDOW + 1)]

#: Public forms that look like keys: identifiers, addresses of files and pages, digests of subresources, alphabets.
ALLOWED = re.compile(
    r"""[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}
      | sha(?:256|384|512)-[A-Za-z0-9+/]+=*
      | [a-z]+(?:[-_/](?:[a-z]{1,12}|[0-9]{1,12}|[a-z]+[0-9]+|[0-9]+[a-z]+))+
      | (?:0123456789)?(?:abcdefghijklmnopqrstuvwxyz|ABCDEFGHIJKLMNOPQRSTUVWXYZ)+(?:0123456789)?[+/]*
      | [0-9+/_=-]+""",
    re.VERBOSE,
)
#: A group between separators that mixes digits and small letters as keys do: in strings that have one, separators are
#: neutral to the class of a window.
KEY_GROUP = re.compile(r"(?<![A-Za-z0-9])(?=[a-z]*[0-9]+[a-z]+[0-9])[a-z0-9]{12,}(?![A-Za-z0-9])")
IDENTIFIER = re.compile(r"(?<![A-Za-z0-9])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?![A-Za-z0-9])")
SEPARATORS = "-_"
DIGIT, LOWER, UPPER = re.compile("[0-9]"), re.compile("[a-z]"), re.compile("[A-Z]")
PLACEHOLDER = "<SECRET>"


def base_spans(text: str) -> list[Span]:
    """Spans of the three fixed patterns, each leftmost and non-overlapping within its kind."""
    spans: list[Span] = []
    if ("=" in text or ":" in text) and any(w in (low := text.lower()) for w in ASSIGN_WORDS):
        spans += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return spans


def window_class(counts: dict[str, int], digits: int, lower: int, upper: int, outside_hex: int, neutral: int = 0) -> str | None:
    """The narrowest class of a window's characters but ``neutral`` separators, or None for windows that are words."""
    size = WINDOW - neutral
    if not digits or digits == size:
        return None
    if outside_hex == neutral:
        return "hex"
    if digits + lower == size or digits + upper == size:
        return "alnum"
    return "base64" if lower and upper else None


def entropy_windows(candidate: str) -> Iterator[int]:
    """Starts of the windows whose entropy reaches their class's threshold, by incremental counts."""
    counts: dict[str, int] = {}
    total = 0.0
    digits = lower = upper = outside_hex = neutral = 0
    separators = SEPARATORS if KEY_GROUP.search(candidate) else ""
    for at, c in enumerate(candidate):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += CLOGC[n + 1] - CLOGC[n]
        digits += "0" <= c <= "9"
        lower += "a" <= c <= "z"
        upper += "A" <= c <= "Z"
        outside_hex += c not in HEX_CHARS
        neutral += c in separators
        if at >= WINDOW:
            gone = candidate[at - WINDOW]
            n = counts[gone]
            counts[gone] = n - 1
            total += CLOGC[n - 1] - CLOGC[n]
            digits -= "0" <= gone <= "9"
            lower -= "a" <= gone <= "z"
            upper -= "A" <= gone <= "Z"
            outside_hex -= gone not in HEX_CHARS
            neutral -= gone in separators
        if at >= WINDOW - 1:
            kind = window_class(counts, digits, lower, upper, outside_hex, neutral)
            least = THRESHOLDS[kind] if kind else None
            # entropy = log2(W) - sum(c log2 c) / W
            if least is not None and LOG_WINDOW - total / WINDOW >= least:
                yield at - WINDOW + 1


LOG_WINDOW = log2(WINDOW)


def keyed(part: str) -> bool:
    """Whether any window of a string reaches its class's entropy."""
    return next(entropy_windows(part), None) is not None


def entropy_spans(text: str) -> list[Span]:
    """Candidate strings with a high-entropy window that the allow-list does not suppress, but for a name before ``=``."""
    spans: list[Span] = []
    for match in CANDIDATE.finditer(text):
        if ALLOWED.fullmatch(match.group()):
            continue
        # identifiers inside paths and names are no keys; what stands around them is looked at by itself
        cuts = [match.start(), *(x for m in IDENTIFIER.finditer(match.group()) for x in (match.start() + m.start(), match.start() + m.end()))]
        for start, end in zip(cuts[::2], [*cuts[1::2], match.end()], strict=True):
            part = text[start:end]
            if not DIGIT.search(part) or not (LOWER.search(part) or UPPER.search(part)):
                continue
            first = next(entropy_windows(part), None)
            if first is not None:
                # the windows' ends are no ends of the key: the whole unbroken string is taken
                value = part.rfind("=", 0, first + WINDOW - 1) + 1
                named = value and keyed(part[value:]) and not keyed(part[:value])
                spans.append((start + value if named else start, end, "entropy"))
    return spans


def all_spans(text: str) -> list[Span]:
    """Every span by start, then kind."""
    return in_order(base_spans(text) + entropy_spans(text))


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each group of overlapping spans replaced by one placeholder."""
    out, at, reach = [], 0, -1
    for start, end, _ in in_order(spans):
        if start >= reach:
            out += [text[at:start], PLACEHOLDER]
            reach = end
        reach = max(reach, end)
        at = reach
    return "".join([*out, text[at:]])


def scan_secrets(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per span: ``key``, kind, span_start, span_end and the text found."""
    fields = "doc_id:int64 kind:string span_start:int64 span_end:int64 found:string"
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            yield to_batch([(i, kind, a, b, t[a:b]) for i, t in texts for a, b, kind in all_spans(t)], schema)

    return arrow_map(_input(df, key, text), run, fields).withColumnRenamed("doc_id", key)


def secret_digests(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with counts, the digest of the base spans and all spans spelled out."""
    fields = "doc_id:int64 n_assign:int64 n_access:int64 n_hex:int64 n_entropy:int64 base_sha256:string spans:string"
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                spans = all_spans(t)
                base = spelled([s for s in spans if s[2] in BASE_KINDS])
                counts = (sum(s[2] == kind for s in spans) for kind in KINDS)
                rows.append((i, *counts, hashlib.sha256(base.encode()).hexdigest(), spelled(spans)))
            yield to_batch(rows, schema)

    return arrow_map(_input(df, key, text), run, fields).withColumnRenamed("doc_id", key)


def redact_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns, with every span of ``text`` replaced; null stays null."""

    @F.pandas_udf("string")
    def redact(texts):  # noqa: ANN001, ANN202
        return texts.map(lambda t: t if t is None else redacted(t, all_spans(t)))

    return df.withColumn(text, redact(F.col(text)))


def _input(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(df[key].cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))

"""Many search intents at once. Filters, words and vectors of all of them meet the documents in joins, not in a loop.

The frame of intents has one row per ``query_id`` and any of the columns of :class:`SearchIntent`, with the query's
``vector`` in place of its semantic text (``operators/embed.py`` makes vectors of texts). Columns that are missing
count as null, and null means "not asked for".
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpweave.functions.text import normalise_keyword
from corpweave.operators import search as s
from corpweave.operators.blocks import Block
from corpweave.operators.joins import join_with_small
from corpweave.session import stored
from corpweave.specs import EMBEDDING_FIELDS, INTENT_BOOSTS, TEXT_FIELDS

INTENT_TYPES = {
    "k": "bigint",
    "query_text": "string",
    "query_text_fields": "array<string>",
    "vector": "array<double>",
    "embedding_fields": "array<string>",
    "country": "string",
    "iso2_country_code": "string",
    "company_id": "string",
    "normalized_request_url": "string",
    "min_employees": "bigint",
    "max_employees": "bigint",
    "min_founded_year": "bigint",
    "max_founded_year": "bigint",
    "min_revenue": "bigint",
    "max_revenue": "bigint",
}
# Equalities, most telling first; and ranges as (column of the documents, lower bound, upper bound).
EQUAL = ("company_id", "normalized_request_url", "iso2_country_code", "country")
RANGES = (
    ("founded_year", "min_founded_year", "max_founded_year"),
    ("employees_count", "min_employees", "max_employees"),
    ("revenue_quantity_lower_bound", "min_revenue", None),
    ("revenue_quantity_upper_bound", None, "max_revenue"),
)
FILTERS = [*EQUAL, *(bound for _, low, high in RANGES for bound in (low, high) if bound)]
LAST_BIN = 64
QUERY_SLICE = 128


def _plain(name: str) -> Column:
    """A value as it is compared: names of countries without case and accents."""
    return normalise_keyword(F.col(name)) if name in s.FILTER_KEYWORD_LIMITS else F.col(name)


def _facts(docs: DataFrame, vectors: list[str] | tuple = (), also: list[str] | tuple = ()) -> DataFrame:
    """What filters look at: hk, one column ``f_...`` a filtered column, some vectors, and others. Nothing else is read."""
    columns = []
    for name in EQUAL:
        limit = s.FILTER_KEYWORD_LIMITS.get(name)
        value = _plain(name) if limit is None else F.when(F.length(name) <= limit, _plain(name))
        columns.append(value.cast("string").alias(f"f_{name}"))
    columns += [F.col(name).cast("bigint").alias(f"f_{name}") for name, _, _ in RANGES]
    return docs.select("hk", *columns, *[F.col(name).cast("array<double>").alias(name) for name in vectors], *also)


def _asked(intents: DataFrame) -> DataFrame:
    """Intents with all columns, their filters as ``w_...`` and as one text that names the set of filters."""
    there = set(intents.columns)
    full = intents.select(
        "query_id", *[(F.col(n) if n in there else F.lit(None)).cast(kind).alias(n) for n, kind in INTENT_TYPES.items()]
    )
    wanted = [_plain(name).alias(f"w_{name}") for name in FILTERS]
    asked = full.select(
        "query_id",
        F.coalesce("k", F.lit(1)).alias("k"),
        "query_text",
        "query_text_fields",
        "vector",
        F.array_distinct(F.coalesce("embedding_fields", F.array(F.lit("embedding_global_vector")))).alias("embedding_fields"),
        *wanted,
    )
    semantic = F.col("vector").isNotNull() & (F.size("embedding_fields") > 0)
    return asked.withColumn("vector", F.when(semantic, F.col("vector"))).withColumn(
        "filters", F.to_json(F.struct(*[f"w_{name}" for name in FILTERS]))
    )


def _check_fields(asked: DataFrame) -> None:
    for column, allowed in (("query_text_fields", TEXT_FIELDS), ("embedding_fields", EMBEDDING_FIELDS)):
        named = asked.select(F.explode(column).alias("name")).filter(~F.col("name").isin(*allowed))
        unknown = [row["name"] for row in named.distinct().orderBy("name").limit(5).collect()]
        if unknown:
            raise ValueError(f"unknown {column}: {unknown}")


def _passes() -> Column:
    """Whether a document (``f_...``) passes all filters of an intent (``w_...``)."""
    parts = [F.col(f"w_{n}").isNull() | F.coalesce(F.col(f"f_{n}") == F.col(f"w_{n}"), F.lit(False)) for n in EQUAL]
    for name, low, high in RANGES:
        value = F.col(f"f_{name}")
        if low:
            parts.append(F.col(f"w_{low}").isNull() | F.coalesce(value >= F.col(f"w_{low}"), F.lit(False)))
        if high:
            parts.append(F.col(f"w_{high}").isNull() | F.coalesce(value <= F.col(f"w_{high}"), F.lit(False)))
    return reduce(lambda a, b: a & b, parts)


def _any_filter() -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"w_{name}").isNotNull() for name in FILTERS])


# filters alone


def _bin(name: str, value: Column) -> Column:
    """Bins that grow with the value: five years each for years, doubling widths for amounts. Ends are open."""
    if name == "founded_year":
        bins = F.least(F.greatest(F.floor((value - 1800) / 5), F.lit(0)), F.lit(LAST_BIN))
        return F.when(value.isNotNull(), bins).cast("int")
    return F.when(value < 1, 0).otherwise(F.floor(F.log2(value.cast("double"))) + 1).cast("int")


def _key(kind: str, value: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), value.cast("string"))


def _keys(kind: str, values: Column) -> Column:
    return F.transform(values, lambda value: _key(kind, value))


def _set_keys() -> Column:
    """The index keys under which a set of filters looks for documents: one value, the bins of one range, or all."""
    choice = None
    for name in EQUAL:
        key = F.array(_key(name, F.col(f"w_{name}")))
        given = F.col(f"w_{name}").isNotNull()
        choice = F.when(given, key) if choice is None else choice.when(given, key)
    ends = [(n, F.col(f"w_{lo}") if lo else F.lit(None), F.col(f"w_{hi}") if hi else F.lit(None)) for n, lo, hi in RANGES]
    for closed in (True, False):
        for name, low, high in ends:
            given = (low.isNotNull() & high.isNotNull()) if closed else (low.isNotNull() | high.isNotNull())
            first = F.coalesce(_bin(name, low.cast("bigint")), F.lit(0))
            last = F.coalesce(_bin(name, high.cast("bigint")), F.lit(LAST_BIN))
            bins = F.sequence(first, F.greatest(first, last))
            choice = choice.when(given, _keys(name, bins))
    return choice.otherwise(F.array(F.lit("all:")))


def _document_keys(kinds: set[str]) -> Column:
    """The index keys of a document, of the kinds that some set of filters uses."""
    keys = [_key(name, F.col(f"f_{name}")) for name in EQUAL if name in kinds]
    keys += [_key(name, _bin(name, F.col(f"f_{name}"))) for name, _, _ in RANGES if name in kinds]
    keys += [F.lit("all:")] if "all" in kinds else []
    return F.array_compact(F.array(*keys))


def _filter_hits(facts: DataFrame, only: DataFrame, size: int, max_broadcast: int) -> DataFrame:
    """The first ``size`` documents, by key, of every intent that has filters alone.

    Intents with the same filters are answered once. A set of filters stands in the index under one value or the bins of
    one range; documents meet it there, and the whole condition decides. Tasks cut each set's documents to ``size`` before
    they are shuffled.
    """
    sets = only.select("filters", *[f"w_{n}" for n in FILTERS]).distinct().withColumn("key", F.explode(_set_keys()))
    kinds = {r[0] for r in sets.select(F.substring_index("key", ":", 1)).distinct().collect()}
    if not kinds:
        return only.select("query_id", F.lit("").alias("hk"), F.lit(1.0).alias("score")).filter(F.lit(False))
    entries = facts.withColumn("key", F.explode(_document_keys(kinds)))
    met = join_with_small(entries, sets, ["key"], F.col("hk"), max_rows=max_broadcast).filter(_passes())
    place = F.row_number().over(Window.partitionBy("filters").orderBy("hk"))
    best = stored(met.select("filters", "hk").withColumn("place", place).filter(F.col("place") <= size).drop("place"), "filter-hits")
    hits = join_with_small(only.select("query_id", "filters"), best, ["filters"], F.col("query_id"), max_rows=max_broadcast)
    return hits.select("query_id", "hk", F.lit(1.0).alias("score"))


# words


def _text_scores(
    docs: DataFrame, facts: DataFrame, asked: DataFrame, bind_hybrid: bool, index: s.TextIndex, max_broadcast: int
) -> DataFrame:
    """BM25 of every intent with text on its own fields from a stored index, then its filters on the documents that matched.

    Statistics are those of the whole table. Only keys and filtered columns are joined to the matches.
    """
    queries, binding = _texts(asked, bind_hybrid)
    scores = s.bm25_scores(docs, queries, INTENT_BOOSTS, max_broadcast, index)
    binding = binding.filter(_any_filter())
    if binding.isEmpty():
        return scores
    judged = join_with_small(scores, binding, ["query_id"], F.col("hk"), "left", max_rows=max_broadcast)
    return judged.join(facts, "hk").filter(_passes()).select("query_id", "hk", "score")


def _texts(asked: DataFrame, bind_hybrid: bool) -> tuple[DataFrame, DataFrame]:
    """The texts asked for with their fields, and the filters that bind them."""
    texts = asked.filter(F.col("query_text").isNotNull())
    queries = texts.select("query_id", F.col("query_text").alias("text"), F.col("query_text_fields").alias("fields"))
    binding = texts if bind_hybrid else texts.filter(F.col("vector").isNull())
    return queries, binding.select("query_id", *[f"w_{n}" for n in FILTERS])


def _text_hits(docs: DataFrame, asked: DataFrame, vector: DataFrame, bind_hybrid: bool, size: int, max_broadcast: int) -> DataFrame:
    """BM25 of the ``size`` best documents of every intent with text in every block, and of its ``vector`` hits.

    Filters decide inside the block. What comes among the best by text and vector together without being a vector hit is
    among the best by text, since a vector adds nothing below zero.
    """
    queries, binding = _texts(asked, bind_hybrid)
    pairs = vector.select("query_id", "hk")
    facts = tuple(f"f_{name}" for name in [*EQUAL, *(name for name, _, _ in RANGES)])

    def rules(ids: pa.Array) -> _TextRules:
        mine = F.broadcast(docs.sparkSession.createDataFrame(pa.table({"query_id": ids})))
        return _TextRules(ids, binding.join(mine, "query_id").toArrow(), pairs.join(mine, "query_id").toArrow())

    read = _facts(docs, also=list(INTENT_BOOSTS))
    return s.text_hits(read, queries, INTENT_BOOSTS, size, None, max_broadcast, facts, rules)


class _TextRules:
    """The filters of some intents with text, and the documents whose text scores their vectors need."""

    def __init__(self, ids: pa.Array, binding: pa.Table, pairs: pa.Table) -> None:
        place = pc.index_in(ids, value_set=binding.column("query_id").combine_chunks())
        self.filters = _Filters(binding.combine_chunks().take(place))
        self.queries = pc.index_in(pairs.column("query_id"), value_set=ids).to_numpy()
        self.keys = pairs.column("hk").combine_chunks()

    def allowed(self, block: Block, part: slice) -> np.ndarray:
        return self.filters.allowed(block.documents.combine_chunks().to_batches()[0], part)

    def needed(self, block: Block, part: slice) -> np.ndarray:
        mask = np.zeros((block.count, part.stop - part.start), dtype=bool)
        asked = np.flatnonzero((self.queries >= part.start) & (self.queries < part.stop))
        docs = pc.index_in(self.keys.take(pa.array(asked)), value_set=block.keys.combine_chunks())
        docs = pc.fill_null(docs, -1).to_numpy(zero_copy_only=False)
        mask[docs[docs >= 0], self.queries[asked[docs >= 0]] - part.start] = True
        return mask


# vectors


class _Filters:
    """The filters of some intents as arrays."""

    def __init__(self, table: pa.Table) -> None:
        self.values, self.codes, self.bounds = {}, {}, {}
        for name in EQUAL:
            column = table.column(f"w_{name}").combine_chunks()
            self.values[name] = pc.unique(column.drop_null())
            self.codes[name] = _codes(column, self.values[name], absent=-2)
        for _, low, high in RANGES:
            for bound in (low, high):
                if bound:
                    self.bounds[bound] = _numbers(table.column(f"w_{bound}").combine_chunks())

    def allowed(self, docs: pa.RecordBatch, part: slice) -> np.ndarray:
        """Documents by queries of the slice: whether the filters let the document through."""
        count = part.stop - part.start
        mask = np.ones((docs.num_rows, count), dtype=bool)
        for name in EQUAL:
            wanted = self.codes[name][part]
            if (wanted != -2).any():
                found = _codes(docs.column(f"f_{name}"), self.values[name], absent=-1)
                mask &= (wanted == -2)[None, :] | (found[:, None] == wanted[None, :])
        for name, low, high in RANGES:
            for bound, compare in ((low, np.greater_equal), (high, np.less_equal)):
                if bound and self.bounds[bound][1][part].any():
                    limit, given = (a[part] for a in self.bounds[bound])
                    value, there = _numbers(docs.column(f"f_{name}"))
                    mask &= ~given[None, :] | (there[:, None] & compare(value[:, None], limit[None, :]))
        return mask


class _Block(_Filters):
    """The vectors of some intents for one field and size, with their filters."""

    def __init__(self, table: pa.Table) -> None:
        matrix = s._matrix(table.column("vector"))
        matrix[~np.isfinite(matrix).all(axis=1)] = 0
        self.units, usable = s._unit_rows(matrix)
        kept = table.filter(pa.array(usable))
        self.ids = kept.column("query_id").combine_chunks()
        super().__init__(kept)


def _codes(column: pa.Array, values: pa.Array, absent: int) -> np.ndarray:
    return pc.fill_null(pc.index_in(column, value_set=values), absent).to_numpy(zero_copy_only=False)


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return pc.fill_null(column, 0).to_numpy(zero_copy_only=False), pc.is_valid(column).to_numpy(zero_copy_only=False)


def _score_block(docs: pa.RecordBatch, field: str, blocks: dict[int, _Block], size: int) -> Iterator[pa.RecordBatch]:
    lengths = pc.fill_null(pc.list_value_length(docs.column(field)), 0)
    for dim, block in blocks.items():
        rows = docs.filter(pc.equal(lengths, dim))
        if not rows.num_rows or not len(block.ids):
            continue
        matrix = s._matrix(rows.column(field))
        matrix[~np.isfinite(matrix).all(axis=1)] = 0
        units, usable = s._unit_rows(matrix)
        rows = rows.filter(pa.array(usable))
        order = pc.sort_indices(rows.column("hk"))
        rows, units = rows.take(order), units[order.to_numpy()]
        for start in range(0, len(block.ids), QUERY_SLICE):
            part = slice(start, min(start + QUERY_SLICE, len(block.ids)))
            scores = np.round((1.0 + units @ block.units[part].T) / 2.0, s.RANK_PLACES)
            scores[~block.allowed(rows, part)] = -np.inf
            found, asked = np.nonzero(s._best_of_block(scores, size) & np.isfinite(scores))
            yield pa.RecordBatch.from_arrays(
                [
                    block.ids.take(pa.array(asked + start)),
                    pa.array([field] * len(found), pa.string()),
                    rows.column("hk").take(pa.array(found)),
                    pa.array(scores[found, asked]),
                ],
                names=["query_id", "field", "hk", "score"],
            )


def _vector_scores(docs: DataFrame, asked: DataFrame, size: int, max_vectors: int) -> DataFrame:
    """The ``size`` nearest documents that pass the filters, for every intent and field, summed over fields.

    Each pass hands about ``max_vectors`` intents with their filters to all tasks, which measure their own documents and
    keep the best. Documents never move; more intents take more passes.
    """
    kind = asked.schema["query_id"].dataType
    schema = T.StructType(
        [
            T.StructField("query_id", kind),
            T.StructField("field", T.StringType()),
            T.StructField("hk", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    vectors = asked.filter(F.col("vector").isNotNull()).select(
        "query_id", "vector", F.explode("embedding_fields").alias("field"), *[f"w_{n}" for n in FILTERS]
    )
    count = vectors.count()
    passes = max(1, -(-count // max_vectors))
    hits = docs.sparkSession.createDataFrame([], schema)
    names = [row["field"] for row in vectors.select("field").distinct().orderBy("field").collect()]
    scanned = _facts(docs, names)
    for n in range(passes if count else 0):
        chunk = vectors.filter(F.pmod(F.xxhash64("query_id"), F.lit(passes)) == n).toArrow()
        if not chunk.num_rows:
            continue
        lengths = pc.list_value_length(chunk.column("vector"))
        blocks: dict[str, dict[int, _Block]] = {}
        for name in names:
            mine = pc.equal(chunk.column("field"), name)
            for dim in pc.unique(lengths.filter(mine)).to_pylist():
                if dim:
                    blocks.setdefault(name, {})[dim] = _Block(chunk.filter(pc.and_(mine, pc.equal(lengths, dim))))
        shared = docs.sparkSession.sparkContext.broadcast(blocks)

        def score(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for name, by_size in shared.value.items():
                    yield from _score_block(batch, name, by_size, size)

        hits = hits.unionByName(scanned.mapInArrow(score, schema))
    place = F.row_number().over(Window.partitionBy("query_id", "field").orderBy(F.desc("score"), F.asc("hk")))
    best = hits.withColumn("place", place).filter(F.col("place") <= size)
    return best.groupBy("query_id", "hk").agg(F.round(F.sum("score"), s.RANK_PLACES).alias("score"))


# all together


def search_intents(
    docs: DataFrame,
    intents: DataFrame,
    size: int = 10,
    filter_text_branch: bool = True,
    index: s.TextIndex | None = None,
    max_broadcast: int = s.MAX_BROADCAST_TERMS,
    max_vectors: int = s.MAX_BROADCAST_VECTORS,
) -> DataFrame:
    """Run every intent with the strategy its columns call for; at most ``min(k, size)`` ranked hits each.

    Hits equal those of :func:`corpweave.operators.search.search` for the same intent: text gives BM25, a vector nearest
    neighbours, both their sum, neither whatever passes the filters. Zero vectors, vectors of another size than the
    documents' and vectors with a component that is null or not finite meet nothing. Unknown field names raise.
    """
    asked = stored(_asked(intents), "intents")
    _check_fields(asked)
    facts = _facts(docs)
    only = asked.filter(F.col("query_text").isNull() & F.col("vector").isNull())
    plain = _filter_hits(facts, only, size, max_broadcast)
    vector = stored(_vector_scores(docs, asked, size, max_vectors), "vector-hits")
    if index is None:
        text = stored(_text_hits(docs, asked, vector, filter_text_branch, size, max_broadcast), "text-hits")
    else:
        text = _text_scores(docs, facts, asked, filter_text_branch, index, max_broadcast)
    scores = s.hybrid_scores(text, vector).unionByName(plain.select("query_id", "hk", "score"))
    best = s._placed(scores, size).join(asked.select("query_id", "k"), "query_id").filter(F.col("rank") <= F.col("k"))
    return best.select("query_id", "rank", "hk", s._shown())

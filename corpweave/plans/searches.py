"""Queries: search over the gold table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.operators import intents as many
from corpweave.operators import pruned
from corpweave.operators import search as s
from corpweave.operators import vector_index as v
from corpweave.plans import oracle as o
from corpweave.plans.domain import Tables
from corpweave.session import scratch_path
from corpweave.specs import INTENT_BOOSTS, TEXT_SEARCH_BOOSTS

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SIZE = 10


def query(name: str, sql: str | None = None):
    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def _out(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", F.col("rank").cast("bigint").alias("rank"), "hk", "score")


def _top(scores: str, size: int = SIZE) -> str:
    """Ranked hits of (query_id, hk, score)."""
    return f"""SELECT query_id, rank, hk, round(score, 6) AS score FROM (
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, hk) AS rank, hk, score FROM {scores}) WHERE rank <= {size}"""


def _bm25_steps(queries: str, boosts: dict[str, float]) -> dict[str, str]:
    """Named sub-queries ending in ``bm25`` (query_id, hk, score)."""

    def words(c: str) -> str:
        return o.tokens(f"array_to_string({c}, ' ')" if c in o.LIST_FIELDS else c)

    boost = "CASE field " + " ".join(f"WHEN '{f}' THEN {b}" for f, b in boosts.items()) + " END"
    return {
        "queries": queries,
        "query_terms": f"SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({o.tokens('text')}) AS term FROM queries) GROUP BY ALL",
        "field_words": "SELECT * FROM ("
        + " UNION ALL ".join(f"SELECT hk, '{f}' AS field, {words(f)} AS words FROM gold" for f in boosts)
        + ") WHERE len(words) > 0",
        "field_stats": "SELECT field, count(*) AS n, sum(len(words)) / CAST(count(*) AS DOUBLE) AS avg_len FROM field_words GROUP BY field",
        "postings": """SELECT hk, field, len, term, count(*) AS tf FROM (SELECT hk, field, len(words) AS len, unnest(words) AS term FROM field_words)
WHERE term IN (SELECT term FROM query_terms) GROUP BY ALL""",
        "term_stats": """SELECT field, term, any_value(avg_len) AS avg_len, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf
FROM postings JOIN field_stats USING (field) GROUP BY field, term""",
        "bm25": f"""SELECT query_id, hk, round(max(s), 9) AS score FROM (
  SELECT query_id, hk, field, sum(qtf * {boost} * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg_len))) AS s
  FROM postings JOIN term_stats USING (field, term) JOIN query_terms USING (term) GROUP BY query_id, hk, field) GROUP BY query_id, hk""",
    }


def _knn_steps(vector: str, fields: list[str], docs: str, size: int = SIZE) -> dict[str, str]:
    """Named sub-queries ending in ``knn`` (hk, score)."""
    fields_sql = " UNION ALL ".join(
        f"SELECT hk, '{f}' AS field, round((1 + list_cosine_similarity({f}, {vector})) / 2, 9) AS score FROM {docs}" for f in fields
    )
    return {
        "field_scores": fields_sql,
        "knn": f"""SELECT hk, round(sum(score), 9) AS score FROM (SELECT * FROM field_scores WHERE score IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY field ORDER BY score DESC, hk) <= {size}) GROUP BY hk""",
    }


_QUERY_VECTOR = "(SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)"


def _query_vector(t: Tables):
    """The vector asked for: the first one of the embeddings table."""
    return t["embeddings"].filter("vec_id = 0").select(F.col("embedding").cast("array<double>")).scalar()


@query(
    "filter_only_search",
    o.query(
        f"""SELECT 'q' AS query_id, row_number() OVER (ORDER BY hk) AS rank, hk, CAST(1.0 AS DOUBLE) AS score FROM gold
WHERE strip_accents(lower(country)) = 'nation_3' AND strip_accents(lower(iso2_country_code)) = 'dy' QUALIFY rank <= {SIZE}""",
        "gold",
    ),
)
def filter_only_search(t: Tables) -> DataFrame:
    intent = s.SearchIntent(k=SIZE, country="Nation_3", iso2_country_code="DY")
    return _out(s.search(t.serving("hk", "country", "iso2_country_code"), intent, SIZE))


@query(
    "range_filter_search",
    o.query(
        """SELECT 'q' AS query_id, row_number() OVER (ORDER BY hk) AS rank, hk, CAST(1.0 AS DOUBLE) AS score FROM gold
WHERE employees_count >= 200 AND employees_count <= 900 AND founded_year >= 1960 AND founded_year <= 2010
  AND revenue_quantity_lower_bound >= 5 AND revenue_quantity_upper_bound <= 100 QUALIFY rank <= 50""",
        "gold",
    ),
)
def range_filter_search(t: Tables) -> DataFrame:
    intent = s.SearchIntent(
        k=50, min_employees=200, max_employees=900, min_founded_year=1960, max_founded_year=2010, min_revenue=5, max_revenue=100
    )
    ranges = ("employees_count", "founded_year", "revenue_quantity_lower_bound", "revenue_quantity_upper_bound")
    return _out(s.search(t.serving("hk", *ranges), intent, 50))


@query(
    "keyword_exact",
    o.query(
        f"""SELECT 'q' AS query_id, row_number() OVER (ORDER BY hk) AS rank, hk, CAST(1.0 AS DOUBLE) AS score FROM gold
WHERE len(list_filter(market_niches, lambda x: length(x) <= 256 AND replace(strip_accents(lower(x)), 'ß', 'ss') = 'src3')) > 0
QUALIFY rank <= {SIZE}""",
        "gold",
    ),
)
def keyword_exact(t: Tables) -> DataFrame:
    return _out(s.search_keyword(t.serving("hk", "market_niches"), "market_niches", "SRC3", SIZE))


@query(
    "keyword_match",
    o.query(
        _top("bm25"), "gold", extra=_bm25_steps("SELECT 'q' AS query_id, 'Src3 en' AS text", {"market_niches": 1.0})
    ),
)
def keyword_match(t: Tables) -> DataFrame:
    return _out(s.search_keyword(t.serving("hk", "market_niches"), "market_niches", "Src3 en", SIZE, exact=False))


_TEXT = "furniture machinery that and estion queaux"


@query(
    "search_bm25",
    o.query(
        _top("(SELECT * FROM bm25 WHERE hk IN (SELECT hk FROM gold WHERE employees_count >= 100))"),
        "gold",
        extra=_bm25_steps(f"SELECT 'q' AS query_id, '{_TEXT}' AS text", INTENT_BOOSTS),
    ),
)
def search_bm25(t: Tables) -> DataFrame:
    gold = t.serving("hk", "employees_count", *INTENT_BOOSTS)
    return _out(s.search(gold, s.SearchIntent(k=SIZE, query_text=_TEXT, min_employees=100), SIZE))


@query(
    "search_bm25_min_score",
    o.query(
        _top("(SELECT * FROM bm25 WHERE score >= 1.5)", 500),
        "gold",
        extra=_bm25_steps(f"SELECT 'q' AS query_id, '{_TEXT}' AS text", TEXT_SEARCH_BOOSTS),
    ),
)
def search_bm25_min_score(t: Tables) -> DataFrame:
    queries = t.spark.createDataFrame([("q", _TEXT)], "query_id string, text string")
    return _out(s.search_text(t.serving("hk", *TEXT_SEARCH_BOOSTS), queries, TEXT_SEARCH_BOOSTS, 500, 1.5))


_FIELDS = ["embedding_global_vector", "embedding_description_short"]
_FILTERED = "(SELECT * FROM gold WHERE employees_count >= 100)"


@query(
    "search_knn",
    o.query(
        _top("(SELECT 'q' AS query_id, * FROM knn)"), "gold", extra=_knn_steps(_QUERY_VECTOR, _FIELDS, _FILTERED)
    ),
)
def search_knn(t: Tables) -> DataFrame:
    intent = s.SearchIntent(k=SIZE, semantic_query="like the first vector", embedding_fields=_FIELDS, min_employees=100)
    return _out(s.search(t.serving("hk", "employees_count", *_FIELDS), intent, SIZE, query_vector=_query_vector(t)))


@query(
    "search_hybrid",
    o.query(
        _top(
            """(SELECT query_id, hk, round(sum(score), 9) AS score FROM (
  SELECT query_id, hk, score FROM bm25 WHERE hk IN (SELECT hk FROM gold WHERE employees_count >= 100)
  UNION ALL SELECT 'q', hk, score FROM knn) GROUP BY query_id, hk)"""
        ),
        "gold",
        extra={
            **_bm25_steps(f"SELECT 'q' AS query_id, '{_TEXT}' AS text", {f: INTENT_BOOSTS[f] for f in ("industry", "description_long")}),
            **_knn_steps(_QUERY_VECTOR, _FIELDS, _FILTERED),
        },
    ),
)
def search_hybrid(t: Tables) -> DataFrame:
    intent = s.SearchIntent(
        k=SIZE,
        query_text=_TEXT,
        query_text_fields=["industry", "description_long"],
        semantic_query="like the first vector",
        embedding_fields=_FIELDS,
        min_employees=100,
    )
    gold = t.serving("hk", "employees_count", "industry", "description_long", *_FIELDS)
    return _out(s.search(gold, intent, SIZE, query_vector=_query_vector(t)))


@query(
    "search_enriched",
    o.query(
        "SELECT rank, g.hk, g.company_id, g.industry, g.description_long, score FROM ("
        + _top("(SELECT 'q' AS query_id, * FROM knn)")
        + ") h JOIN gold g ON g.hk = h.hk",
        "gold",
        extra=_knn_steps(_QUERY_VECTOR, ["embedding_global_vector"], "gold"),
    ),
)
def search_enriched(t: Tables) -> DataFrame:
    gold = t.serving("hk", "company_id", "industry", "description_long", "embedding_global_vector")
    hits = s.search_knn(gold, _query_vector(t), ["embedding_global_vector"], SIZE)
    records = s.enrich(hits, gold.select("hk", "company_id", "industry", "description_long"))
    return records.select(F.col("rank").cast("bigint").alias("rank"), "hk", "company_id", "industry", "description_long", "score")


@query(
    "search_batch_bm25",
    o.query(
        _top("bm25"),
        "gold",
        extra=_bm25_steps("SELECT item_id AS query_id, text FROM benchmark", INTENT_BOOSTS),
    ),
)
def search_batch_bm25(t: Tables) -> DataFrame:
    """Every benchmark text asked at once, over all text fields."""
    queries = t["benchmark"].select(F.col("item_id").alias("query_id"), "text")
    return _out(s.search_text(t.serving("hk", *INTENT_BOOSTS), queries, INTENT_BOOSTS, SIZE))


@query(
    "search_batch_pruned",
    o.query(
        _top("bm25"),
        "gold",
        extra=_bm25_steps("SELECT item_id AS query_id, text FROM benchmark", INTENT_BOOSTS),
    ),
)
def search_batch_pruned(t: Tables) -> DataFrame:
    """Every benchmark text asked of a stored impact index, which leaves out what cannot reach the tenth score."""
    index = pruned.build_impacts(t.serving("hk", *INTENT_BOOSTS), scratch_path(t.spark, "impact-index"), list(INTENT_BOOSTS))
    queries = t["benchmark"].select(F.col("item_id").alias("query_id"), "text")
    return _out(pruned.search_pruned(index, queries, INTENT_BOOSTS, SIZE))


@query(
    "search_batch_knn",
    o.query(
        _top("pairs"),
        "gold",
        extra={
            "pairs": """SELECT vec_id AS query_id, hk, round((1 + list_cosine_similarity(embedding_global_vector, CAST(embedding AS DOUBLE[]))) / 2, 9) AS score
FROM gold, embeddings WHERE embedding_global_vector IS NOT NULL"""
        },
    ),
)
def search_batch_knn(t: Tables) -> DataFrame:
    """The nearest companies of every vector of the embeddings table."""
    queries = t["embeddings"].select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("vector"))
    return _out(s.search_knn_batch(t.serving("hk", "embedding_global_vector"), queries, "embedding_global_vector", SIZE))


@query(
    "search_knn_index",
    o.query(
        _top("pairs"),
        "gold",
        extra={
            "pairs": """SELECT vec_id AS query_id, hk, round((1 + list_cosine_similarity(embedding_global_vector, CAST(embedding AS DOUBLE[]))) / 2, 9) AS score
FROM gold, embeddings WHERE embedding_global_vector IS NOT NULL AND vec_id % 50 = 0"""
        },
    ),
)
def search_knn_index(t: Tables) -> DataFrame:
    """Every 50th vector asked of a stored index of inverted lists."""
    path = scratch_path(t.spark, "vector-index")
    index = v.build_vector_index(t.serving("hk", "embedding_global_vector"), "embedding_global_vector", path)
    queries = t["embeddings"].filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("vector"))
    return _out(v.search_index(index, queries, SIZE))


# Intents of every kind, one a benchmark text: (column, when it is given, its value), the same words in both engines.
_INTENT_COLUMNS = (
    ("query_text", "i % 4 IN (0, 2)", "text"),
    ("country", "i % 5 = 1", "concat('NATION_', CAST(i % 25 AS STRING))"),
    ("company_id", "i % 16 = 3", "concat('cmp_', CAST(i AS STRING))"),
    ("min_employees", "i % 3 = 2", "i * 7"),
    ("max_employees", "i % 7 = 2", "4000"),
    ("min_founded_year", "i % 6 = 3", "1950 + i % 60"),
    ("max_founded_year", "i % 9 = 3", "2010"),
    ("min_revenue", "i % 10 = 5", "5"),
    ("max_revenue", "i % 10 = 7", "100"),
)
_SOME_TEXT_FIELDS = ("industry", "description_long")


def _intents_sql() -> str:
    columns = ", ".join(f"CASE WHEN {when} THEN {value} END AS {name}" for name, when, value in _INTENT_COLUMNS)
    fields, vectors = (", ".join(f"'{f}'" for f in names) for names in (_SOME_TEXT_FIELDS, _FIELDS))
    return f"""SELECT i AS query_id, 1 + i % 12 AS k, {columns}, CASE WHEN i % 3 = 0 THEN [{fields}] END AS fields,
  CASE WHEN i % 4 IN (1, 2) THEN CAST(embedding AS DOUBLE[]) END AS vector,
  CASE WHEN i % 8 IN (1, 2) THEN [{vectors}] ELSE ['{_FIELDS[0]}'] END AS vector_fields
FROM (SELECT item_id AS i, text, embedding FROM benchmark LEFT JOIN embeddings ON vec_id = item_id)"""


_PASSES = """(i.country IS NULL OR coalesce(replace(strip_accents(lower(g.country)), 'ß', 'ss') = lower(i.country), false))
  AND (i.company_id IS NULL OR coalesce(g.company_id = i.company_id, false))
  AND (i.min_employees IS NULL OR coalesce(g.employees_count >= i.min_employees, false))
  AND (i.max_employees IS NULL OR coalesce(g.employees_count <= i.max_employees, false))
  AND (i.min_founded_year IS NULL OR coalesce(g.founded_year >= i.min_founded_year, false))
  AND (i.max_founded_year IS NULL OR coalesce(g.founded_year <= i.max_founded_year, false))
  AND (i.min_revenue IS NULL OR coalesce(g.revenue_quantity_lower_bound >= i.min_revenue, false))
  AND (i.max_revenue IS NULL OR coalesce(g.revenue_quantity_upper_bound <= i.max_revenue, false))"""


def _intent_steps() -> dict[str, str]:
    steps = {"intents": _intents_sql(), **_bm25_steps("SELECT query_id, query_text AS text FROM intents WHERE query_text IS NOT NULL", INTENT_BOOSTS)}
    boost = "CASE field " + " ".join(f"WHEN '{f}' THEN {b}" for f, b in INTENT_BOOSTS.items()) + " END"
    steps["passing"] = f"SELECT i.query_id, g.hk FROM intents i JOIN gold g ON {_PASSES}"
    del steps["bm25"]  # it comes again below, behind what it needs
    steps["bm25"] = f"""SELECT query_id, hk, round(max(s), 9) AS score FROM (
  SELECT query_id, hk, field, sum(qtf * {boost} * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg_len))) AS s
  FROM postings JOIN term_stats USING (field, term) JOIN query_terms USING (term) JOIN intents USING (query_id)
  WHERE fields IS NULL OR list_contains(fields, field) GROUP BY query_id, hk, field) x SEMI JOIN passing USING (query_id, hk) GROUP BY query_id, hk"""
    steps["knn"] = " UNION ALL ".join(
        f"""SELECT query_id, hk, score FROM (SELECT query_id, hk, round((1 + list_cosine_similarity({f}, vector)) / 2, 9) AS score
  FROM passing JOIN intents USING (query_id) JOIN gold USING (hk)
  WHERE vector IS NOT NULL AND {f} IS NOT NULL AND list_contains(vector_fields, '{f}'))
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, hk) <= {SIZE}"""
        for f in (f"{name}" for name in _FIELDS)
    )
    steps["scored"] = """SELECT query_id, hk, round(sum(score), 9) AS score FROM (
  SELECT * FROM bm25 UNION ALL SELECT query_id, hk, round(sum(score), 9) FROM (SELECT * FROM knn) GROUP BY query_id, hk) GROUP BY query_id, hk
UNION ALL SELECT query_id, hk, 1.0 FROM passing JOIN intents USING (query_id) WHERE query_text IS NULL AND vector IS NULL"""
    return steps


@query(
    "search_batch_intents",
    o.query(f"SELECT h.* FROM ({_top('scored')}) h JOIN intents USING (query_id) WHERE rank <= k", "gold", extra=_intent_steps()),
)
def search_batch_intents(t: Tables) -> DataFrame:
    """One intent a benchmark text, of all four strategies, each with filters of its own."""
    i = t["benchmark"].join(t["embeddings"], F.col("vec_id") == F.col("item_id"), "left").withColumn("i", F.col("item_id"))
    intents = i.select(
        F.col("i").alias("query_id"),
        F.expr("1 + i % 12").alias("k"),
        *[F.expr(f"CASE WHEN {when} THEN {value} END").alias(name) for name, when, value in _INTENT_COLUMNS],
        F.when(F.col("i") % 3 == 0, F.array(*[F.lit(f) for f in _SOME_TEXT_FIELDS])).alias("query_text_fields"),
        F.when((F.col("i") % 4).isin(1, 2), F.col("embedding").cast("array<double>")).alias("vector"),
        F.when((F.col("i") % 8).isin(1, 2), F.array(*[F.lit(f) for f in _FIELDS])).alias("embedding_fields"),
    )
    filtered = [*many.EQUAL, *(name for name, _, _ in many.RANGES)]
    gold = t.serving("hk", *filtered, *INTENT_BOOSTS, *_FIELDS)
    return _out(many.search_intents(gold, intents, SIZE))

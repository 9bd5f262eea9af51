"""Queries: scans, cleaning functions, standardising, validation, keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.functions import text, urls, vectors
from corpweave.functions.keys import hub_key, key_hash, payload_hash, uuid5
from corpweave.functions.revenue import parse_revenue
from corpweave.operators import embed
from corpweave.operators.integrate import dedupe_latest, decode_partition, encode_partition, integrate, union_chunks, unmatched
from corpweave.operators.gold import confidential, gold_hdiff, redact, to_gold
from corpweave.operators.report import table_counts
from corpweave.operators.standardise import to_bronze
from corpweave.operators.validate import bad_rows, validation_metrics
from corpweave.plans import oracle as o
from corpweave.plans.domain import DIM, Tables, flat_list, vector_sum
from corpweave.sources.countries import lookup_country
from corpweave.sources.files import describe_filled
from corpweave.specs import EMBEDDING_FIELDS, ENRICHMENT_RAW, INTEGRATED_SILVER, VECTOR_COLUMNS

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function name or the one given, with its checking SQL when there is one."""

    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or build.__name__
        QUERIES[key] = build
        if sql is not None:
            ORACLES[key] = sql
        return build

    return add


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def scan_parquet(t: Tables) -> DataFrame:
    return t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01' AND l_discount >= 0.05 AND l_returnflag = 'R'"""
)
def scan_filter_project(t: Tables) -> DataFrame:
    return (
        t["lineitem"]
        .filter((F.col("l_shipdate") >= "1998-01-01") & (F.col("l_shipdate") < "1999-01-01"))
        .filter((F.col("l_discount") >= 0.05) & (F.col("l_returnflag") == "R"))
        .select("l_orderkey", "l_linenumber", "l_extendedprice")
    )


_COUNT_SQL = " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS n FROM {n}" for n in TABLES)


@query(f"{_COUNT_SQL} UNION ALL " + "SELECT * FROM (" + o.query("SELECT 'gold' AS \"table\", count(*) AS n FROM gold", "gold") + ")",
    name="table_counts",
)
def count_tables(t: Tables) -> DataFrame:
    return table_counts({**{name: t[name] for name in TABLES}, "gold": t.gold()})


_DESCRIBED = " UNION ALL ".join(
    f"SELECT '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS type, count({f.name}) AS filled, count(*) AS total FROM integrated"
    for f in INTEGRATED_SILVER.fields
)


@query(o.query(_DESCRIBED, "integrated"))
def describe_schema(t: Tables) -> DataFrame:
    return describe_filled(t.integrated())


@query(
    o.query(
        f"""SELECT doc_id, {o.soft('text')} AS cleaned FROM documents
UNION ALL SELECT -1 - c_custkey, {o.soft('raw')} FROM (
  SELECT c_custkey, '  ' || CAST(c_acctbal AS VARCHAR) || chr(9) || CASE WHEN c_acctbal < 0 THEN c_mktsegment ELSE '' END || chr(10) AS raw
  FROM customer)"""
    )
)
def soft_string(t: Tables) -> DataFrame:
    label = F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).otherwise(F.lit(""))
    balance = F.concat(F.lit("  "), F.col("c_acctbal").cast("string"), F.lit("\t"), label, F.lit("\n"))
    documents = t["documents"].select("doc_id", text.soft_string(F.col("text")).alias("cleaned"))
    balances = t["customer"].select((-1 - F.col("c_custkey")).alias("doc_id"), text.soft_string(balance).alias("cleaned"))
    return documents.unionByName(balances)


@query(o.query(f"SELECT company_id, employee_count, {o.soft_int('employee_count')} AS employees FROM registry_raw", "registry_raw"))
def soft_int(t: Tables) -> DataFrame:
    return t.registry_raw().select("company_id", "employee_count", text.soft_int(F.col("employee_count")).alias("employees"))


@query(
    f"""SELECT *, substr(normalised, 1, 5) AS prefix_key FROM (SELECT page_id, url, {o.normalise_url('url')} AS normalised FROM (
SELECT page_id, CASE page_id % 4 WHEN 0 THEN replace(url, 'example', '%65x%61mple') WHEN 1 THEN url || '/%7Ea b%2f%zz%2' ELSE url END AS url
FROM pages))"""
)
def normalise_url(t: Tables) -> DataFrame:
    """Every page's URL, some with needless, needed and broken escapes and a blank."""
    page, url = F.col("page_id"), F.col("url")
    planted = F.when(page % 4 == 0, F.replace(url, F.lit("example"), F.lit("%65x%61mple"))).when(
        page % 4 == 1, F.concat(url, F.lit("/%7Ea b%2f%zz%2"))
    )
    pages = t["pages"].select("page_id", F.coalesce(planted, url).alias("url"))
    keyed = pages.withColumn("normalised", urls.normalise_url(F.col("url")))
    return keyed.withColumn("prefix_key", urls.url_partition_key(F.col("normalised")))


@query(
    o.query(
        "SELECT company_id, revenue_range, "
        + ", ".join(f"{sql} AS {name}" for name, sql in o.revenue("revenue_range").items())
        + " FROM registry_raw",
        "registry_raw",
    ),
    name="parse_revenue",
)
def parse_revenue_band(t: Tables) -> DataFrame:
    parts = parse_revenue(F.col("revenue_range"))
    return t.registry_raw().select("company_id", "revenue_range", *[c.alias(name) for name, c in parts.items()])


@query(
    o.query(
        f"""SELECT url, len(s) AS n_services, {o.flat_list('s')} AS services, len(m) AS n_niches, {o.flat_list('m')} AS niches,
  len(b) AS n_models, {o.flat_list('b')} AS models
FROM (SELECT url, {o.keywords('product_services', 'chr(10)')} AS s, {o.keywords('market_niches', 'chr(10)')} AS m,
  {o.keywords('business_model', "'|'")} AS b FROM enrichment_raw)""",
        "enrichment_raw",
    )
)
def split_keywords(t: Tables) -> DataFrame:
    lists = t.enrichment_raw().select(
        "url",
        text.split_keywords(F.col("product_services"), "\n").alias("s"),
        text.split_keywords(F.col("market_niches"), "\n").alias("m"),
        text.split_keywords(F.col("business_model"), "|").alias("b"),
    )
    named = [("s", "services"), ("m", "niches"), ("b", "models")]
    return lists.select(
        "url",
        *[F.size(c).cast("bigint").alias(f"n_{name}") for c, name in named],
        *[flat_list(F.col(c)).alias(name) for c, name in named],
    )


@query(
    f"""SELECT word, count(*) AS n FROM (SELECT unnest({o.tokens('text')}) AS word FROM documents) GROUP BY word"""
)
def tokenise(t: Tables) -> DataFrame:
    words = t["documents"].select(F.explode(text.tokenise(F.col("text"))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query(
    o.query(
        f"""SELECT company_id, n.country_name AS country, n.iso2 FROM registry_raw r
LEFT JOIN countries n ON n.alias = lower({o.soft('r.country', 3)})""",
        "registry_raw",
        "countries",
    )
)
def country_lookup(t: Tables) -> DataFrame:
    found = lookup_country(t.registry_raw().select("company_id", "country"), "country", t.countries())
    return found.select("company_id", F.col("country_name").alias("country"), "iso2")


@query(
    o.query(
        f"SELECT url, len(product_services_emb) AS n_dims, product_services_emb IS NULL OR len(product_services_emb) = {DIM} AS ok FROM embeddings_raw",
        "embeddings_raw",
    )
)
def embedding_dims(t: Tables) -> DataFrame:
    vector = F.col("product_services_emb")
    return t.embeddings_raw().select(
        "url",
        F.size(vector).cast("bigint").alias("n_dims"),
        (~vectors.wrong_dimension(vector, DIM)).alias("ok"),
    )


@query(
    o.query(
        """SELECT url__normalized_request_url AS url, desc__description_long AS description_long, ps AS product_services,
  mn AS market_niches, bm AS business_model,
  array_to_string(list_filter([desc__description_long, ps, mn, bm], lambda x: x IS NOT NULL AND x <> ''), ' ') AS global_text
FROM (SELECT *, array_to_string(desc__product_services, ' | ') AS ps, array_to_string(desc__market_niches, ' | ') AS mn,
  array_to_string(desc__business_model, ' | ') AS bm FROM enrichment)""",
        "enrichment",
    )
)
def embedding_text(t: Tables) -> DataFrame:
    rows = t.enrichment().select(
        F.col("url__normalized_request_url").alias("url"),
        *[F.col(f"desc__{c}").alias(c) for c in ("description_long", "product_services", "market_niches", "business_model")],
    )
    texts = embed.embedding_texts(rows)
    return rows.select("url", *[c.alias("global_text" if n == "global_vector" else n) for n, c in texts.items()])


_EMBEDDED = {
    "description_long": "desc__description_long",
    "product_services": "array_to_string(desc__product_services, ' | ')",
    "market_niches": "array_to_string(desc__market_niches, ' | ')",
    "business_model": "array_to_string(desc__business_model, ' | ')",
}
_PARTS = {**_EMBEDDED, "global_vector": "concat_ws(' ', " + ", ".join(f"nullif({e}, '')" for e in _EMBEDDED.values()) + ")"}
_EMBED_SQL = (
    "WITH texts AS ("
    + " UNION ALL ".join(f"SELECT {o._KEY} AS url, '{n}' AS field, nullif({e}, '') AS text FROM enrichment" for n, e in _PARTS.items())
    + f"""), words AS (SELECT url, field, md5(unnest({o.tokens('text')})) AS d FROM texts),
slots AS (SELECT url, field, CAST('0x' || substr(d, 1, 6) AS BIGINT) % {DIM} AS slot,
  CAST(sum(CASE WHEN substr(d, 32, 1) < '8' THEN 1 ELSE -1 END) AS DOUBLE) AS n FROM words GROUP BY ALL),
scaled AS (SELECT *, coalesce(n / nullif(sqrt(sum(n * n) OVER (PARTITION BY url, field)), 0), 0) AS v FROM slots),
sums AS (SELECT url, field, sum(v) AS plain, sum(v * (slot + 1)) AS placed FROM scaled GROUP BY ALL)
SELECT t.url, """
    + ", ".join(
        f"max(CASE WHEN t.field = '{n}' AND t.text IS NOT NULL THEN round(coalesce(s.{c}, 0), 6) END) AS embedding_{n}{tail}"
        for n in _PARTS for c, tail in (("plain", ""), ("placed", "_placed"))
    )
    + " FROM texts t LEFT JOIN sums s ON s.url IS NOT DISTINCT FROM t.url AND s.field = t.field GROUP BY t.url"
)


@query(o.query(f"SELECT * FROM ({_EMBED_SQL})", "enrichment"))
def embed_columns(t: Tables) -> DataFrame:
    """Hashed vectors of every text field, compared by their sums and by their sums weighted with the slot."""
    rows = t.enrichment().select(
        F.col("url__normalized_request_url").alias("url"),
        *[F.col(f"desc__{c}").alias(c) for c in ("description_long", "product_services", "market_niches", "business_model")],
    )
    encoded = embed.hashed_vectors(rows, "url", embed.embedding_texts(rows), DIM)
    names = [c for c in encoded.columns if c != "url"]
    placed = {c: F.transform(F.col(c), lambda v, i: v * (i + 1)) for c in names}
    sums = [x for c in names for x in (vector_sum(F.col(c)).alias(c), vector_sum(placed[c]).alias(f"{c}_placed"))]
    return encoded.select("url", *sums)


@query(
    o.query(
        f"""SELECT company_id, sha256({o.std("coalesce(company_id, '~~NULL~~')")}) AS company_hash,
  sha256({o.std("coalesce(country, '~~NULL~~')")}) AS country_hash, {o.std('country')} AS country_std FROM registry_raw""",
        "registry_raw",
    )
)
def hash_keys(t: Tables) -> DataFrame:
    from corpweave.functions.keys import std

    return t.registry_raw().select(
        "company_id",
        key_hash(F.col("company_id")).alias("company_hash"),
        key_hash(F.col("country")).alias("country_hash"),
        std(F.col("country")).alias("country_std"),
    )


@query(
    f"""SELECT c_custkey, {o.hub_key('c_name')} AS hk, {o.uuid5('c_name')} AS name_uuid FROM customer"""
)
def hub_key_uuid5(t: Tables) -> DataFrame:
    return t["customer"].select(
        "c_custkey", hub_key(F.col("c_name"), "integrated").alias("hk"), uuid5(F.col("c_name")).alias("name_uuid")
    )


_D1_HASHED = {c: c for c in o._D1 if c != "id__company"}
_D2_HASHED = {
    c: f"to_json({c})" if c in ("desc__product_services", "desc__market_niches", "desc__business_model") else c
    for c in o._URLS + ["desc__description_long", "desc__product_services", "desc__market_niches", "desc__business_model"]
    if c != "url__normalized_request_url"
}
GOLD_HASH = o.payload_hash(
    {
        **{c: c for c in o.SCALAR_FIELDS if c != "company_id"},
        **{c: f"to_json({c})" for c in o.LIST_FIELDS},
        "embedding_ldts": "epoch_us(embedding_ldts)",
    }
)


@query(
    o.query(
        f"""SELECT 'registry' AS stage, id__company AS key, {o.payload_hash(_D1_HASHED)} AS hdiff FROM registry
UNION ALL SELECT 'enrichment', url__normalized_request_url, {o.payload_hash(_D2_HASHED)} FROM enrichment
UNION ALL SELECT 'gold', hk, {GOLD_HASH} FROM gold""",
        "registry",
        "enrichment",
        "gold",
    )
)
def hash_diff(t: Tables) -> DataFrame:
    """Change hashes of two silver tables and of gold (there without the vectors, whose JSON text differs by engine)."""

    def hashed(df: DataFrame, stage: str, key: str) -> DataFrame:
        value = payload_hash(df, [c for c in df.columns if c != key])
        return df.select(F.lit(stage).alias("stage"), F.col(key).alias("key"), value.alias("hdiff"))

    # both tables are hashed and joined into gold: they are worked out once
    registry, enrichment = t.registry_table(), t.enrichment_table()
    gold = to_gold(integrate(registry, enrichment, t.embeddings()))
    gold_part = gold.select(
        F.lit("gold").alias("stage"), F.col("hk").alias("key"), gold_hdiff(gold, set(EMBEDDING_FIELDS)).alias("hdiff")
    )
    return (
        hashed(registry, "registry", "id__company")
        .unionByName(hashed(enrichment, "enrichment", "url__normalized_request_url"))
        .unionByName(gold_part)
    )


@query(o.query("SELECT * FROM registry", "registry"))
def standardise_registry(t: Tables) -> DataFrame:
    return t.registry()


_LISTS = ("desc__product_services", "desc__market_niches", "desc__business_model")


@query(
    o.query(
        f"""SELECT {', '.join(o._URLS)}, desc__description_long, {', '.join(f'{o.flat_list(c)} AS {c}' for c in _LISTS)}
FROM enrichment_checked WHERE NOT bad_url""",
        "enrichment_checked",
    )
)
def standardise_enrichment(t: Tables) -> DataFrame:
    from corpweave.operators.validate import good_rows

    rows = good_rows(t.enrichment_checked())
    return rows.withColumns({c: flat_list(F.col(c)) for c in _LISTS})


@query(
    o.query(
        f"""SELECT {', '.join(o._URLS)}, {', '.join(f'len({c}) AS n_{c}, {o.vector_sum(c)} AS sum_{c}' for c in VECTOR_COLUMNS.values())},
  epoch_us(dt__embedding_ldts) AS embedded_us FROM embeddings_checked WHERE NOT bad_url AND len(bad_dimensions) = 0 AND NOT bad_time""",
        "embeddings_checked",
    )
)
def standardise_embeddings(t: Tables) -> DataFrame:
    from corpweave.operators.validate import good_rows

    rows = good_rows(t.embeddings_checked())
    sizes = [F.col(f"{c}.dimensions").cast("bigint").alias(f"n_{c}") for c in VECTOR_COLUMNS.values()]
    sums = [vector_sum(F.col(f"{c}.embedding")).alias(f"sum_{c}") for c in VECTOR_COLUMNS.values()]
    return rows.select(*o._URLS, *sizes, *sums, F.unix_micros("dt__embedding_ldts").alias("embedded_us"))


_CHECKED = ("registry_checked", "enrichment_checked", "embeddings_checked")
_BAD = {
    "registry": "(bad_id OR bad_year)",
    "enrichment": "bad_url",
    "embeddings": "(bad_url OR len(bad_dimensions) > 0 OR bad_time)",
}


def _checked(t: Tables) -> dict[str, DataFrame]:
    return {
        "registry": t.registry_checked(),
        "enrichment": t.enrichment_checked(),
        "embeddings": t.embeddings_checked(),
    }


def _union(frames: list[DataFrame]) -> DataFrame:
    from functools import reduce

    return reduce(DataFrame.unionByName, frames)


@query(
    o.query(
        " UNION ALL ".join(
            f"SELECT '{s}' AS source, NOT {bad} AS ok, count(*) AS n FROM {s}_checked GROUP BY ALL" for s, bad in _BAD.items()
        ),
        *_CHECKED,
    )
)
def validate_split(t: Tables) -> DataFrame:
    return _union(
        [
            df.groupBy((F.size("_errors") == 0).alias("ok")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(s).alias("source"), "ok", "n")
            for s, df in _checked(t).items()
        ]
    )


@query(
    o.query(
        """SELECT 'registry' AS data_source, company_id AS key,
  array_to_string(list_filter([CASE WHEN bad_id THEN 'missing_company_id' END,
    CASE WHEN bad_year THEN 'founded_year_out_of_range' END], lambda x: x IS NOT NULL), ',') AS reasons
FROM registry_checked WHERE bad_id OR bad_year
UNION ALL SELECT 'enrichment', url, 'missing_url' FROM enrichment_checked WHERE bad_url
UNION ALL SELECT 'embeddings', url, array_to_string(list_filter([CASE WHEN bad_url THEN 'missing_url' END]
    || bad_dimensions || [CASE WHEN bad_time THEN 'bad_timestamp' END], lambda x: x IS NOT NULL), ',')
FROM embeddings_checked WHERE bad_url OR len(bad_dimensions) > 0 OR bad_time""",
        *_CHECKED,
    )
)
def quarantine_rows(t: Tables) -> DataFrame:
    key = {"registry": "raw.company_id", "enrichment": "raw.url", "embeddings": "raw.url"}
    return _union(
        [
            bad_rows(df, s, "run").select("data_source", F.col(key[s]).alias("key"), F.array_join("reasons", ",").alias("reasons"))
            for s, df in _checked(t).items()
        ]
    )


@query(
    o.query(
        " UNION ALL ".join(
            f"""SELECT '{s}' AS data_source, count(*) FILTER (WHERE NOT {bad}) AS success, count(*) FILTER (WHERE {bad}) AS failures,
  count(*) AS total, round(100.0 * count(*) FILTER (WHERE NOT {bad}) / CAST(count(*) AS DOUBLE), 2) AS success_rate FROM {s}_checked"""
            for s, bad in _BAD.items()
        ),
        *_CHECKED,
    ),
    name="validation_metrics",
)
def validation_metrics_by_source(t: Tables) -> DataFrame:
    return _union([validation_metrics(df, s) for s, df in _checked(t).items()])


@query(
    o.query(
        """SELECT id__company, coalesce(loc__iso2_country_code, 'UNKNOWN') AS stored, loc__iso2_country_code AS read_back FROM registry""",
        "registry",
    )
)
def partition_sentinel(t: Tables) -> DataFrame:
    code = "loc__iso2_country_code"
    stored = encode_partition(t.registry(), code)
    both = decode_partition(stored.withColumn("stored", F.col(code)), code)
    return both.select("id__company", "stored", F.col(code).alias("read_back"))


@query(
    o.query(
        f"SELECT {', '.join(c for c in o._D1 if not c.startswith('fin__'))} FROM registry",
        "registry",
    )
)
def redact_columns(t: Tables) -> DataFrame:
    rows = t.registry()
    return redact(confidential(rows, *[c for c in rows.columns if c.startswith("fin__")]))


@query(
    o.query(
        """SELECT id__company, url__normalized_request_url AS url, CAST(cnt__employees AS BIGINT) AS cnt__employees,
  CAST(NULL AS VARCHAR) AS desc__description_long FROM registry
UNION ALL SELECT NULL, url__normalized_request_url, NULL, desc__description_long FROM enrichment
UNION ALL SELECT id__company, NULL, CAST(dt__founded_year AS INTEGER), NULL FROM registry""",
        "registry",
        "enrichment",
    ),
    name="union_chunks",
)
def union_chunk_tables(t: Tables) -> DataFrame:
    url = F.col("url__normalized_request_url").alias("url")
    first = t.registry().select("id__company", url, "cnt__employees")
    second = t.enrichment().select(url, "desc__description_long")
    third = t.registry().select("id__company", F.col("dt__founded_year").cast("int").alias("cnt__employees"))
    return union_chunks(first, second, third)

_VARIANTS = """SELECT page_id, url, 0 AS variant FROM pages
UNION ALL SELECT page_id, regexp_replace(url, '^https?://(www\\.)?', 'http://www.'), 1 FROM pages
UNION ALL SELECT page_id, regexp_replace(url, '^https?://(www\\.)?', ''), 2 FROM pages"""


@query(
    o.query(
        f"""SELECT normalised, page_id, variant, url FROM (SELECT *, {o.normalise_url('url')} AS normalised FROM variants)
QUALIFY row_number() OVER (PARTITION BY normalised ORDER BY variant DESC, page_id) = 1""",
        extra={"variants": _VARIANTS},
    ),
    name="dedupe_latest",
)
def dedupe_latest_rows(t: Tables) -> DataFrame:
    pages = t["pages"].select("page_id", "url")
    prefix = r"^https?://(www\.)?"
    variants = _union(
        [
            pages.withColumn("variant", F.lit(0)),
            pages.select("page_id", F.regexp_replace("url", prefix, "http://www.").alias("url"), F.lit(1).alias("variant")),
            pages.select("page_id", F.regexp_replace("url", prefix, "").alias("url"), F.lit(2).alias("variant")),
        ]
    )
    keyed = variants.withColumn("normalised", urls.normalise_url(F.col("url")))
    return dedupe_latest(keyed, "normalised", ["variant"], ["page_id"]).select("normalised", "page_id", "variant", "url")


@query(
    o.query(
        """SELECT url, business_description FROM enrichment_raw WHERE business_description IS NOT NULL AND business_description <> ''""",
        "enrichment_raw",
    )
)
def bronze_blank_to_null(t: Tables) -> DataFrame:
    bronze = to_bronze(t.enrichment_raw(), ENRICHMENT_RAW)
    return bronze.filter(F.col("business_description").isNotNull()).select("url", "business_description")


_UNMATCHED = """SELECT '{name}' AS source, count(*) AS total_rows,
  count(*) FILTER (WHERE url__normalized_request_url NOT IN
    (SELECT url__normalized_request_url FROM registry WHERE url__normalized_request_url IS NOT NULL)) AS unmatched_rows FROM {s}"""


@query(
    o.query(
        " UNION ALL ".join(_UNMATCHED.format(name=n, s=s) for n, s in (("enrichment", "enrichment"), ("embeddings", "vectors"))),
        "registry",
        "enrichment",
        "vectors",
    )
)
def unmatched_enrichment(t: Tables) -> DataFrame:
    return unmatched(t.registry(), ("enrichment", t.enrichment()), ("embeddings", t.embeddings()))

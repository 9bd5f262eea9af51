"""The same company frames as SQL text for the checking engine, as a chain of named sub-queries."""

from __future__ import annotations

from corpweave.functions.text import WHITESPACE, WHITESPACE_CLASS
from corpweave.functions.urls import UNRESERVED

_WS = "'" + WHITESPACE + "'"
_JUNK = r"'^[\p{Nd}[:punct:]" + WHITESPACE_CLASS + "]+$'"
_SCHEME = r"'^[A-Za-z][A-Za-z0-9+.\-]*://'"


def strip(c: str) -> str:
    return f"trim({c}, {_WS})"


def soft(c: str, min_length: int = 1) -> str:
    s = strip(c)
    return f"CASE WHEN length({s}) >= {min_length} AND NOT regexp_matches({s}, {_JUNK}) THEN {s} END"


def soft_int(c: str) -> str:
    text = f"CAST({c} AS VARCHAR)"
    well_formed = f"regexp_matches({text}, '^[\\s]*[+-]?[0-9]+(_[0-9]+)*(\\.0+)?[\\s]*$')"
    digits = f"TRY_CAST(replace(regexp_extract({text}, '([+-]?[0-9_]+)', 1), '_', '') AS BIGINT)"
    return f"CASE WHEN {well_formed} AND {digits} >= 0 THEN {digits} END"


def keywords(c: str, separator: str) -> str:
    items = f"list_transform(string_split({c}, {separator}), lambda x: {soft('x')})"
    return f"coalesce(list_filter({items}, lambda x: x IS NOT NULL), CAST([] AS VARCHAR[]))"


def canonical_escapes(c: str) -> str:
    parts = f"string_split(replace({c}, ' ', '%20'), '%')"
    character = "chr(CAST('0x' || substr(p, 1, 2) AS INTEGER))"
    decoded = f"CASE WHEN regexp_matches(p, '{UNRESERVED}') THEN {character} || substr(p, 3) ELSE '%' || p END"
    return f"({parts}[1] || array_to_string(list_transform({parts}[2:], lambda p: {decoded}), ''))"


def normalise_url(c: str) -> str:
    u = f"regexp_replace({canonical_escapes(strip(c))}, '(?s)#.*$', '')"
    body = f"regexp_replace({u}, {_SCHEME}, '')"
    has_scheme = f"regexp_matches({u}, {_SCHEME})"
    head = f"split_part({body}, '?', 1)"
    rest = f"regexp_replace({body}, '(?s)^[^?]*\\??', '')"
    pairs = (
        f"list_sort(list_transform(list_filter(string_split({rest}, '&'), lambda a: a <> ''), "
        "lambda a: {'k': split_part(a, '=', 1), 'v': regexp_replace(a, '^[^=]*=?', '')}))"
    )
    query = f"array_to_string(list_transform({pairs}, lambda p: p.k || '=' || p.v), '&')"
    rooted = f"CASE WHEN {has_scheme} AND NOT contains({head}, '/') THEN {head} || '/' ELSE {head} END"
    whole = f"CASE WHEN {query} <> '' THEN {rooted} || '?' || {query} ELSE {head} END"
    trimmed = f"rtrim(CASE WHEN contains({body}, '?') THEN {whole} ELSE {body} END, '/')"
    return (
        f"lower(CASE WHEN {has_scheme} THEN regexp_replace({trimmed}, '^(?i:www\\.)', '') "
        f"ELSE regexp_replace({trimmed}, '^www\\.', '') END)"
    )


def revenue(c: str) -> dict[str, str]:
    sides = {"lower": strip(f"split_part({c}, '-', 1)"), "upper": strip(f"regexp_replace({c}, '(?s)^[^-]*-', '')")}
    usable = f"contains({c}, '-') AND {sides['lower']} <> '' AND {sides['upper']} <> ''"
    out = {}
    for side, raw in sides.items():
        unit = f"regexp_extract({raw}, '([a-zA-Z]+)', 1)"
        quantity = strip(f"replace({raw}, {unit}, '')")
        valid = f"{usable} AND {unit} <> '' AND regexp_matches({quantity}, '^[0-9]+$')"
        out[f"revenue_quantity_{side}_bound"] = f"CASE WHEN {valid} THEN TRY_CAST({quantity} AS BIGINT) END"
        out[f"revenue_unit_{side}_bound"] = f"CASE WHEN {valid} THEN {unit} END"
    return out


def std(c: str) -> str:
    # full case mapping makes the sharp s SS, upper() of this engine makes it one capital letter
    return f"coalesce(nullif(replace(upper({strip(f'CAST({c} AS VARCHAR)')}), 'ẞ', 'SS'), ''), '^~')"


def payload_hash(columns: dict[str, str]) -> str:
    """``columns``: name → SQL text of the value (lists already as JSON)."""
    parts = " || '||' || ".join(std(columns[name]) for name in sorted(columns))
    return f"sha256({std(parts)})"


def uuid5(c: str) -> str:
    digest = f"sha1(unhex('6ba7b8129dad11d180b400c04fd430c8') || encode({strip(c)}))"
    return (
        f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3) || '-' || "
        f"translate(substr({digest}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || "
        f"substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12)"
    )


def hub_key(c: str) -> str:
    return uuid5(f"({std(c)} || '||INTEGRATED')")


def flat_list(c: str) -> str:
    return f"array_to_string({c}, chr(31))"


def vector_sum(c: str) -> str:
    return f"round(list_sum({c}), 6)"


def tokens(c: str) -> str:
    return f"list_filter(string_split_regex(lower({c}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


_REVENUE = revenue("revenue_range")
_YEAR = soft_int("founded_year")
_BAD_YEAR = f"(founded_year IS NOT NULL AND NOT coalesce(({_YEAR}) BETWEEN 1000 AND year(current_date), false))"
_VECTORS = {
    "global_emb": "emb__global_vector",
    "business_description_emb": "emb__description_long",
    "short_description_emb": "emb__description_short",
    "product_services_emb": "emb__product_services",
    "market_niches_emb": "emb__market_niches",
    "business_model_emb": "emb__business_model",
}
_D1 = [
    "id__company",
    "loc__country",
    "loc__iso2_country_code",
    "url__request_url",
    "url__normalized_request_url",
    "cnt__employees",
    "desc__industry",
    "desc__description_short",
    "dt__founded_year",
    "fin__revenue_quantity_lower_bound",
    "fin__revenue_quantity_upper_bound",
    "fin__revenue_unit_lower_bound",
    "fin__revenue_unit_upper_bound",
]
_URLS = ["url__request_url", "url__normalized_request_url", "url__partition_key_url"]
_KEY = "url__normalized_request_url"

STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "registry_raw": (
        (),
        """SELECT 'cmp_' || CAST(c.c_custkey AS VARCHAR) AS company_id,
  CASE WHEN c.c_custkey % 41 = 0 THEN NULL WHEN c.c_custkey % 37 = 0 THEN 'XX' ELSE '  ' || n.n_name END AS country,
  c.c_mktsegment AS industry,
  CASE WHEN c.c_custkey % 13 = 0 THEN NULL WHEN c.c_custkey % 17 = 0 THEN 'unknown'
       WHEN c.c_custkey % 19 = 0 THEN '500-900' WHEN c.c_custkey % 11 = 0 THEN '500M-1B'
       ELSE CAST(1 + c.c_custkey % 50 AS VARCHAR) || 'M-' || CAST(40 + c.c_custkey % 90 AS VARCHAR) || 'M'
  END AS revenue_range,
  CASE WHEN c.c_custkey % 23 = 0 THEN 'n/a' WHEN c.c_custkey % 31 = 0 THEN '-5'
       ELSE CAST(c.c_custkey % 5000 AS VARCHAR) END AS employee_count,
  CASE WHEN c.c_custkey % 29 = 0 THEN 3050 WHEN c.c_custkey % 43 = 0 THEN NULL
       ELSE 1950 + c.c_custkey % 75 END AS founded_year,
  d.text AS short_description, p.url AS website_url
FROM (SELECT *, c_custkey % (SELECT CAST(floor(max(page_id) * 1.25) AS BIGINT) + 1 FROM pages) AS page_ref
      FROM customer) c
JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN pages p ON p.page_id = c.page_ref
LEFT JOIN documents d ON d.doc_id = c.c_custkey""",
    ),
    "enrichment_raw": (
        (),
        """SELECT CASE WHEN d.doc_id % 47 = 3 THEN '123-456' ELSE p.url END AS url, d.text AS business_description,
  replace(d.text, '. ', chr(10)) AS product_services,
  d.lang || chr(10) || d.source || chr(10) || ' ' || chr(10) || '42' AS market_niches,
  'B2B | ' || d.source || ' | SaaS' AS business_model
FROM pages p JOIN documents d ON d.doc_id % (SELECT max(page_id) + 1 FROM pages) = p.page_id""",
    ),
    "embeddings_raw": (
        (),
        """SELECT p.url, e.embedding AS global_emb,
  CASE WHEN e.vec_id % 5 <> 0 THEN e.embedding END AS business_description_emb,
  list_reverse(e.embedding) AS short_description_emb,
  CASE WHEN e.vec_id % 11 = 5 THEN e.embedding[1:len(e.embedding) - 1] ELSE e.embedding END AS product_services_emb,
  CASE WHEN e.vec_id % 3 <> 0 THEN list_reverse(e.embedding) END AS market_niches_emb,
  e.embedding AS business_model_emb,
  CASE WHEN e.vec_id % 53 = 9 THEN 'not a date'
       ELSE '2024-10-' || lpad(CAST(1 + e.vec_id % 28 AS VARCHAR), 2, '0') || 'T'
         || lpad(CAST((e.vec_id // (SELECT max(page_id) + 1 FROM pages)) % 24 AS VARCHAR), 2, '0') || ':52:31Z' END AS embedding_updated_at
FROM pages p JOIN embeddings e ON e.vec_id % (SELECT max(page_id) + 1 FROM pages) = p.page_id""",
    ),
    "countries": (
        (),
        """SELECT lower(n_name) AS alias, n_name AS country_name,
  chr(65 + n_nationkey % 26) || chr(65 + (n_nationkey * 7 + 3) % 26) AS iso2 FROM nation""",
    ),
    "registry_checked": (
        ("registry_raw", "countries"),
        f"""SELECT company_id AS id__company, n.country_name AS loc__country, n.iso2 AS loc__iso2_country_code,
  url__request_url, {normalise_url('url__request_url')} AS url__normalized_request_url,
  {soft_int('employee_count')} AS cnt__employees, {soft('industry')} AS desc__industry,
  {soft('short_description')} AS desc__description_short,
  CASE WHEN NOT {_BAD_YEAR} THEN {_YEAR} END AS dt__founded_year,
  {', '.join(f'{sql} AS fin__{name}' for name, sql in _REVENUE.items())},
  company_id IS NULL AS bad_id, {_BAD_YEAR} AS bad_year, r.*
FROM (SELECT *, {soft('website_url')} AS url__request_url, lower({soft('country', 3)}) AS country_alias
      FROM registry_raw) r
LEFT JOIN countries n ON n.alias = r.country_alias""",
    ),
    "registry": (
        ("registry_checked",),
        f"SELECT {', '.join(_D1)} FROM registry_checked WHERE NOT bad_id AND NOT bad_year",
    ),
    "enrichment_checked": (
        ("enrichment_raw",),
        f"""SELECT *, substr({_KEY}, 1, 5) AS url__partition_key_url FROM (
  SELECT url__request_url, {normalise_url('url__request_url')} AS {_KEY},
    {soft('business_description')} AS desc__description_long,
    {keywords('product_services', 'chr(10)')} AS desc__product_services,
    {keywords('market_niches', 'chr(10)')} AS desc__market_niches,
    {keywords('business_model', "'|'")} AS desc__business_model, url, url__request_url IS NULL AS bad_url
  FROM (SELECT *, {soft('url')} AS url__request_url FROM enrichment_raw))""",
    ),
    "enrichment": (
        ("enrichment_checked",),
        f"""SELECT {', '.join(_URLS)}, desc__description_long, desc__product_services, desc__market_niches,
  desc__business_model FROM enrichment_checked WHERE NOT bad_url
QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY url__request_url, desc__description_long, desc__market_niches) = 1""",
    ),
    "embeddings_checked": (
        ("embeddings_raw",),
        f"""SELECT *, substr({_KEY}, 1, 5) AS url__partition_key_url FROM (
  SELECT url__request_url, {normalise_url('url__request_url')} AS {_KEY},
    {', '.join(f'CAST({raw} AS DOUBLE[]) AS {out}' for raw, out in _VECTORS.items())},
    TRY_CAST(embedding_updated_at AS TIMESTAMPTZ) AS dt__embedding_ldts, url,
    url__request_url IS NULL AS bad_url,
    list_filter([{', '.join(f"CASE WHEN {raw} IS NOT NULL AND len({raw}) <> 64 THEN 'wrong_dimension:{raw}' END" for raw in _VECTORS)}],
      lambda x: x IS NOT NULL) AS bad_dimensions,
    embedding_updated_at IS NOT NULL AND TRY_CAST(embedding_updated_at AS TIMESTAMPTZ) IS NULL AS bad_time
  FROM (SELECT *, {soft('url')} AS url__request_url FROM embeddings_raw))""",
    ),
    "vectors": (
        ("embeddings_checked",),
        f"""SELECT {', '.join(_URLS)}, {', '.join(_VECTORS.values())}, dt__embedding_ldts FROM embeddings_checked
WHERE NOT bad_url AND len(bad_dimensions) = 0 AND NOT bad_time
QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY dt__embedding_ldts DESC, url__request_url) = 1""",
    ),
}
_MAPPED = (
    [f"s.{c}" for c in _D1]
    + [f"x.{c}" for c in ("desc__description_long", "desc__product_services", "desc__market_niches", "desc__business_model")]
    + [f"v.{c}" for c in _VECTORS.values()]
    + ["v.dt__embedding_ldts AS embedding_ldts"]
    + [f"x.{c} AS d2__{c}" for c in _URLS]
    + [f"v.{c} AS d3__{c}" for c in _URLS]
)
STEPS["integrated"] = (
    ("registry", "enrichment", "vectors"),
    f"""SELECT {', '.join(_MAPPED)} FROM registry s
LEFT JOIN enrichment x ON s.{_KEY} = x.{_KEY} LEFT JOIN vectors v ON s.{_KEY} = v.{_KEY}""",
)
GOLD = {
    "company_id": "id__company",
    "country": "loc__country",
    "iso2_country_code": "loc__iso2_country_code",
    "request_url": "url__request_url",
    "normalized_request_url": "url__normalized_request_url",
    "employees_count": "cnt__employees",
    "industry": "desc__industry",
    "description_short": "desc__description_short",
    "founded_year": "dt__founded_year",
    "revenue_quantity_lower_bound": "fin__revenue_quantity_lower_bound",
    "revenue_quantity_upper_bound": "fin__revenue_quantity_upper_bound",
    "revenue_unit_lower_bound": "fin__revenue_unit_lower_bound",
    "revenue_unit_upper_bound": "fin__revenue_unit_upper_bound",
    "description_long": "desc__description_long",
    "product_services": "desc__product_services",
    "market_niches": "desc__market_niches",
    "business_model": "desc__business_model",
    **{f"embedding_{out.removeprefix('emb__')}": out for out in _VECTORS.values()},
    "embedding_ldts": "embedding_ldts",
}
STEPS["gold"] = (
    ("integrated",),
    f"SELECT {hub_key('id__company')} AS hk, {', '.join(f'{src} AS {name}' for name, src in GOLD.items())} FROM integrated",
)
VECTOR_FIELDS = [f"embedding_{out.removeprefix('emb__')}" for out in _VECTORS.values()]
LIST_FIELDS = ["product_services", "market_niches", "business_model"]
SCALAR_FIELDS = [c for c in GOLD if c not in VECTOR_FIELDS + LIST_FIELDS + ["embedding_ldts"]]


def query(select: str, *needs: str, extra: dict[str, str] | None = None) -> str:
    """A SELECT with the sub-queries it needs in front; ``extra`` names further ones, in order."""
    chain: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in chain:
            for parent in STEPS[name][0]:
                add(parent)
            chain[name] = STEPS[name][1]

    for name in needs:
        add(name)
    chain.update(extra or {})
    if not chain:
        return select
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in chain.items()) + "\n" + select

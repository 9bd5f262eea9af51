"""Many intents at once against one search after the other."""

import random

import pytest

from corpweave.operators import search as s
from corpweave.operators.intents import INTENT_TYPES, search_intents
from corpweave.specs import EMBEDDING_FIELDS, TEXT_FIELDS

WORDS = "ferry kiln spruce bean salmon dock tile export pen harbour".split()
DIM = 6
LISTS = {"product_services", "market_niches", "business_model"}
DOCUMENT = ", ".join(
    ["hk string", "company_id string", "country string", "iso2_country_code string", "normalized_request_url string"]
    + [f"{f} {'array<string>' if f in LISTS else 'string'}" for f in TEXT_FIELDS]
    + ["employees_count bigint", "founded_year bigint", "revenue_quantity_lower_bound bigint", "revenue_quantity_upper_bound bigint"]
    + [f"{f} array<double>" for f in EMBEDDING_FIELDS]
    + ["key string", "filters string", "place int"]
)
INTENT = "query_id bigint, " + ", ".join(f"{name} {kind}" for name, kind in INTENT_TYPES.items())


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    some = lambda value, share=0.15: None if rng.random() < share else value
    rows = []
    for i in range(150):
        words = {f: some(rng.choices(WORDS, k=rng.randrange(0, 9))) for f in TEXT_FIELDS}
        texts = [w if f in LISTS or w is None else " ".join(w) for f, w in words.items()]
        vectors = [some([rng.gauss(0, 1) for _ in range(DIM)]) for _ in EMBEDDING_FIELDS]
        if i % 40 == 0:
            vectors[0] = [0.0] * DIM
        numbers = [some(rng.choice([0, 1, 2, 3, 4, 63, 64, 65, 900, 2**40])), some(rng.randrange(1780, 2130)), some(rng.randrange(90)), some(rng.randrange(90))]
        place = [some(f"c{i}"), some(rng.choice(["Perú", "PERU", "Chile", "x" * 300])), some(rng.choice(["PE", "cl"])), some(f"http://{i}")]
        rows.append((f"k{i:03d}", *place, *texts, *numbers, *vectors, "a", "b", 1))
    return spark.createDataFrame(rows, DOCUMENT).repartition(3).cache()


def intents():
    rng = random.Random(8)
    rows = []
    for i in range(32):
        row = dict.fromkeys(INTENT_TYPES)
        row["k"] = rng.choice([None, 0, 3, 20, 20, 20, 20])
        if i % 4 in (0, 2):
            row["query_text"] = rng.choice(["", "kiln bean the kiln", "dock export", "harbour pen"])
            row["query_text_fields"] = rng.choice([None, ["industry"], ["market_niches", "description_long"]])
        if i % 4 in (1, 2):
            row["vector"] = rng.choice([[0.0] * DIM, [1.0] * 3] + [[rng.gauss(0, 1) for _ in range(DIM)]] * 6)
            row["embedding_fields"] = rng.choice([None, EMBEDDING_FIELDS[:2], EMBEDDING_FIELDS[1:2]])
        given = {
            "country": ["peru", "CHILE", "nowhere"],
            "iso2_country_code": ["pe"],
            "company_id": ["c7", "c8"],
            "normalized_request_url": ["http://9"],
            "min_employees": [-1, 0, 2, 64, 2**41],
            "max_employees": [0, 3, 64, 900, 2**62],
            "min_founded_year": [1700, 1805, 1999, 2115],
            "max_founded_year": [1790, 1990, 2200],
            "min_revenue": [0, 30],
            "max_revenue": [10, 80],
        }
        for name in rng.sample(sorted(given), rng.choice([0, 1, 1, 2])):
            row[name] = rng.choice(given[name])
        rows.append(row)
    rows[3].update(dict.fromkeys(given))  # nothing asked at all
    rows[7].update(rows[3])  # the same once more
    # ranges alone: closed, open at either end, one document wide, empty
    ranges = [
        {"min_employees": 2, "max_employees": 64},
        {"min_employees": 64},
        {"max_employees": 3},
        {"min_founded_year": 1700, "max_founded_year": 1900},
        {"min_founded_year": 2115},
        {"max_founded_year": 1812},
        {"min_revenue": 30},
        {"max_revenue": 40, "min_revenue": 10},
        {"min_employees": 2**40, "max_employees": 2**40},
        {"min_founded_year": 2000, "max_founded_year": 1990},
    ]
    rows += [{**dict.fromkeys(INTENT_TYPES), "k": 20, **given} for given in ranges]
    return rows


def one_by_one(docs, rows, size, bind):
    found = []
    for i, row in enumerate(rows):
        given = {name: value for name, value in row.items() if name != "vector" and value is not None}
        vector = row["vector"]
        if vector is not None and len(vector) != DIM:
            vector = [0.0] * DIM
        intent = s.SearchIntent(**given, semantic_query=None if vector is None else "a vector")
        hits = s.search(docs, intent, size, query_vector=vector, filter_text_branch=bind)
        found += [(i, r["rank"], r["hk"], round(r["score"], 5)) for r in hits.collect()]
    return sorted(found)


def rows_of(hits):
    return sorted((r["query_id"], r["rank"], r["hk"], round(r["score"], 5)) for r in hits.collect())


def test_same_hits_as_one_search_after_the_other(spark, docs):
    rows = intents()
    asked = spark.createDataFrame([(i, *row.values()) for i, row in enumerate(rows)], INTENT)
    wanted = one_by_one(docs, rows, 8, True)
    assert len(wanted) > 60
    assert rows_of(search_intents(docs, asked, 8)) == wanted
    # beyond every bound: salted shuffles for filters and words, several passes for vectors
    assert rows_of(search_intents(docs, asked, 8, max_broadcast=1, max_vectors=5)) == wanted


def test_filters_may_bind_the_vectors_of_a_hybrid_alone(spark, docs):
    rows = [row for row in intents() if row["query_text"] and row["vector"]][:4]
    for row in rows:
        row["country"], row["k"] = "chile", 8
    asked = spark.createDataFrame([(i, *row.values()) for i, row in enumerate(rows)], INTENT)
    free = rows_of(search_intents(docs, asked, 8, filter_text_branch=False))
    assert free == one_by_one(docs, rows, 8, False)
    assert free != rows_of(search_intents(docs, asked, 8))


def test_stored_index_empty_frames_and_missing_columns(spark, docs, tmp_path):
    asked = spark.createDataFrame([(1, "kiln dock", 5), (2, "pen", 5)], "query_id bigint, query_text string, k int")
    wanted = rows_of(search_intents(docs, asked, 5))
    assert len(wanted) == 10
    s.write_index(docs, str(tmp_path))
    assert rows_of(search_intents(docs, asked, 5, index=s.TextIndex.read(spark, str(tmp_path)))) == wanted
    assert rows_of(search_intents(docs, asked.limit(0), 5)) == []
    assert rows_of(search_intents(docs.limit(0), spark.createDataFrame([(i, *r.values()) for i, r in enumerate(intents())], INTENT))) == []


def test_unknown_fields_raise(spark, docs):
    asked = spark.createDataFrame([(1, "kiln", ["title"])], "query_id bigint, query_text string, query_text_fields array<string>")
    with pytest.raises(ValueError, match="title"):
        search_intents(docs, asked)


def test_plan_joins_on_keys(spark, docs):
    asked = spark.createDataFrame([(i, *row.values()) for i, row in enumerate(intents())], INTENT)
    plan = search_intents(docs, asked, 8)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan

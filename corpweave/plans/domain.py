"""Company data expressed over the star-schema tables.

The registry is the customers (with their nation, a page as web site and a document as description), the
enrichment source is the documents, the embedding source is the vectors; both are dealt over the pages by their number
modulo that of the pages, so a page's newest vector and first document win.
Awkward values are planted on purpose: unknown and null countries, revenue without a unit or inverted, junk
counts, impossible years, URLs of digits only, companies without URL, vectors of the wrong size, bad dates.
Every customer, page, document and vector takes part, and texts are used whole.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.operators.gold import to_gold
from corpweave.operators.integrate import dedupe_latest, integrate
from corpweave.operators.standardise import standardise_embeddings, standardise_enrichment, standardise_registry
from corpweave.operators.validate import good_rows
from corpweave.session import stored, stored_from

DIM = 64
#: Columns of gold that hold the texts of the enrichment.
ENRICHED = {"description_long", "product_services", "market_niches", "business_model"}


def planned_once(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Keep the logical plan of a frame (never its rows), since building it takes longer than reusing it."""

    @wraps(build)
    def frame(tables: Tables) -> DataFrame:
        if build.__name__ not in tables.plans:
            tables.plans[build.__name__] = build(tables)
        return tables.plans[build.__name__]

    return frame


class Tables:
    """The driver tables of one folder and the company frames derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self.plans: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if f"table:{name}" not in self.plans:
            self.plans[f"table:{name}"] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.plans[f"table:{name}"]

    # raw sources

    @planned_once
    def registry_raw(self) -> DataFrame:
        pages = self["pages"].select("page_id", "url")
        # one reference in five finds no page: those companies have no web site
        references = pages.agg((F.floor(F.max("page_id") * 1.25) + 1).cast("bigint")).scalar()
        customers = self["customer"].withColumn("page_ref", F.col("c_custkey") % references)
        key = F.col("c_custkey")
        revenue = (
            F.when(key % 13 == 0, F.lit(None))
            .when(key % 17 == 0, F.lit("unknown"))
            .when(key % 19 == 0, F.lit("500-900"))
            .when(key % 11 == 0, F.lit("500M-1B"))
            .otherwise(F.concat((1 + key % 50).cast("string"), F.lit("M-"), (40 + key % 90).cast("string"), F.lit("M")))
        )
        employees = (
            F.when(key % 23 == 0, F.lit("n/a")).when(key % 31 == 0, F.lit("-5")).otherwise((key % 5000).cast("string"))
        )
        return (
            customers.join(self["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
            .join(pages, F.col("page_id") == F.col("page_ref"), "left")
            .join(self["documents"].select("doc_id", "text"), F.col("doc_id") == key, "left")
            .select(
                F.concat(F.lit("cmp_"), key.cast("string")).alias("company_id"),
                F.when(key % 41 == 0, F.lit(None))
                .when(key % 37 == 0, F.lit("XX"))
                .otherwise(F.concat(F.lit("  "), "n_name"))
                .alias("country"),
                F.col("c_mktsegment").alias("industry"),
                revenue.alias("revenue_range"),
                employees.alias("employee_count"),
                F.when(key % 29 == 0, F.lit(3050)).when(key % 43 == 0, F.lit(None)).otherwise(1950 + key % 75)
                .cast("bigint").alias("founded_year"),
                F.col("text").alias("short_description"),
                F.col("url").alias("website_url"),
            )
        )

    def page_slots(self) -> int:
        """One more than the highest page number."""
        if "page_slots" not in self.plans:
            self.plans["page_slots"] = (self["pages"].agg(F.max("page_id")).first()[0] or 0) + 1
        return self.plans["page_slots"]

    @planned_once
    def enrichment_raw(self) -> DataFrame:
        pages = self["pages"].select("page_id", "url")
        documents = self["documents"].select("doc_id", "text", "lang", "source")
        newline = F.lit("\n")
        return pages.join(documents, F.col("doc_id") % self.page_slots() == F.col("page_id")).select(
            F.when(F.col("doc_id") % 47 == 3, F.lit("123-456")).otherwise(F.col("url")).alias("url"),
            F.col("text").alias("business_description"),
            F.replace(F.col("text"), F.lit(". "), newline).alias("product_services"),
            F.concat_ws("\n", "lang", "source", F.lit(" "), F.lit("42")).alias("market_niches"),
            F.concat(F.lit("B2B | "), "source", F.lit(" | SaaS")).alias("business_model"),
        )

    @planned_once
    def embeddings_raw(self) -> DataFrame:
        pages = self["pages"].select("page_id", "url")
        vectors = self["embeddings"].select("vec_id", "embedding")
        page, vector = F.col("vec_id"), F.col("embedding")
        none = F.lit(None)
        slots = self.page_slots()
        day = F.lpad((1 + page % 28).cast("string"), 2, "0")
        hour = F.lpad((F.floor(page / slots) % 24).cast("string"), 2, "0")
        return pages.join(vectors, page % slots == F.col("page_id")).select(
            "url",
            vector.alias("global_emb"),
            F.when(page % 5 != 0, vector).alias("business_description_emb"),
            F.reverse(vector).alias("short_description_emb"),
            F.when(page % 11 == 5, F.slice(vector, F.lit(1), F.size(vector) - 1)).otherwise(vector)
            .alias("product_services_emb"),
            F.when(page % 3 != 0, F.reverse(vector)).otherwise(none).alias("market_niches_emb"),
            vector.alias("business_model_emb"),
            F.when(page % 53 == 9, F.lit("not a date"))
            .otherwise(F.concat(F.lit("2024-10-"), day, F.lit("T"), hour, F.lit(":52:31Z")))
            .alias("embedding_updated_at"),
        )

    @planned_once
    def countries(self) -> DataFrame:
        """A country dimension with one spelling per nation."""
        key = F.col("n_nationkey")
        return self["nation"].select(
            F.lower("n_name").alias("alias"),
            F.col("n_name").alias("country"),
            F.concat(F.char(65 + key % 26), F.char(65 + (key * 7 + 3) % 26)).alias("iso2"),
        )

    # checked and silver frames

    @planned_once
    def registry_checked(self) -> DataFrame:
        return standardise_registry(self.registry_raw(), self.countries())

    @planned_once
    def enrichment_checked(self) -> DataFrame:
        return standardise_enrichment(self.enrichment_raw())

    @planned_once
    def embeddings_checked(self) -> DataFrame:
        return standardise_embeddings(self.embeddings_raw(), DIM)

    @planned_once
    def registry(self) -> DataFrame:
        return good_rows(self.registry_checked())

    @planned_once
    def registry_table(self) -> DataFrame:
        """The registry as a stored table, for jobs that load it several times."""
        return stored(self.registry(), "registry")

    @planned_once
    def enrichment(self) -> DataFrame:
        return dedupe_latest(
            good_rows(self.enrichment_checked()),
            "url__normalized_request_url",
            ties=["url__request_url", "desc__description_long", "desc__market_niches"],
        )

    @planned_once
    def enrichment_table(self) -> DataFrame:
        """The enrichment as a stored table, for jobs that read it several times."""
        return stored(self.enrichment(), "enrichment")

    @planned_once
    def embeddings(self) -> DataFrame:
        return dedupe_latest(
            good_rows(self.embeddings_checked()),
            "url__normalized_request_url",
            newest_first=["dt__embedding_ldts"],
            ties=["url__request_url"],
        )

    # joined frames

    @planned_once
    def integrated(self) -> DataFrame:
        return integrate(self.registry(), self.enrichment(), self.embeddings())

    @planned_once
    def gold(self) -> DataFrame:
        return to_gold(self.integrated())

    def serving(self, *columns: str) -> DataFrame:
        """Gold as a stored table, as searches read it: several scans of a few columns each.

        Only ``columns`` are worked out and stored when given: texts, vectors and hashes a job never reads would make up
        nearly all of a table with one wide row a company. Where texts are asked for, their sources are stored first, so that
        what is shuffled for them is gone when they meet, and deleted afterwards.
        """
        name = "serving:" + ",".join(columns)
        if name not in self.plans:
            self.plans[name] = stored_from(self.spark, lambda: self._gold_of(columns), "gold")
        return self.plans[name]

    def _gold_of(self, columns: tuple[str, ...]) -> DataFrame:
        if not ENRICHED & set(columns):
            return self.gold().select(*columns) if columns else self.gold()
        registry = stored(self.registry(), "registry") if "description_short" in columns else self.registry()
        return to_gold(integrate(registry, stored(self.enrichment(), "enrichment"), self.embeddings())).select(*columns)


@lru_cache(maxsize=16)
def tables(spark: SparkSession, folder: str) -> Tables:
    """The frames of one folder in one session."""
    return Tables(spark, folder)


def flat_list(c: Column) -> Column:
    """A list as text, for results compared across engines."""
    return F.array_join(c, "\u001f")


def vector_sum(c: Column) -> Column:
    """Rounded sum of a vector, its fingerprint in results compared across engines."""
    total = F.aggregate(c, F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    return F.round(total, 6)

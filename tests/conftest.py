import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from corpweave.session import build_session  # noqa: E402

DIM = 8

# one company has no web page of its own in the other sources, one has no head count, one no text
COMPANY_FIELDS = (
    "company_id country industry revenue_range employee_count founded_year short_description website_url".split()
)
COMPANIES = [
    ("PT-0417", "Portugal", "Shipbuilding", "20M-40M", 1310, 1962, "Ferries and hull repair on the Tagus", "https://estaleiro-tejo.example"),
    ("JP-2209", "Japan", "Ceramics", None, 37, 1988, "Kiln-fired tiles for bath houses", "kamayaki.example"),
    ("CA-0031", "Canada", "Forestry", "900K-2M", None, 1975, None, "http://www.taiga-timber.example/home"),
    ("BR-5550", "Brazil", "Coffee", "200M-900M", 6400, 2003, "Green beans from the Cerrado", "www.cerrado-graos.example"),
    ("NO-0008", "Norway", "Aquaculture", "60M-70M", 212, 2011, "Salmon raised in closed pens", "fjordlaks.example"),
]
ENRICHMENT_FIELDS = "url business_description product_services market_niches business_model".split()
ENRICHMENTS = [
    ("https://kamayaki.example", "Hand-glazed tiles, fired twice.", "Roof tiles\nGlazing courses", "Inns\nTemples", "Made to order | workshop"),
    ("estaleiro-tejo.example", "Builds ferries and keeps a dry dock for welding and paint.", "Dry dock\nFerry building\nWelding school", "River transport\nPorts", "Tender | long contracts"),
    ("https://www.cerrado-graos.example", "Exports coffee beans roasted or green.", "Green coffee\nRoasted beans", "Roasters\nCafés\nSupermarkets\nAirlines", "Wholesale | commodity export"),
    ("taiga-timber.example/home", "Plants and fells spruce.", "Spruce logs\nSeedlings", "Sawmills", "Lease | wholesale"),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_dir(tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    for folder, fields, rows in (
        ("dataset_1", COMPANY_FIELDS, COMPANIES),
        ("dataset_2", ENRICHMENT_FIELDS, ENRICHMENTS),
    ):
        (base / folder).mkdir()
        (base / folder / "part.json").write_text(json.dumps([dict(zip(fields, r, strict=True)) for r in rows]))
    return base


@pytest.fixture(scope="session")
def embeddings_raw(spark):
    vector = [i / DIM for i in range(1, DIM + 1)]
    rows = [(url, vector, vector[::-1], None, vector, vector, vector, "2024-10-21T06:52:31Z") for url, *_ in ENRICHMENTS]
    return spark.createDataFrame(
        rows,
        "url string, global_emb array<float>, business_description_emb array<float>, short_description_emb array<float>, "
        "product_services_emb array<float>, market_niches_emb array<float>, business_model_emb array<float>, "
        "embedding_updated_at string",
    )


@pytest.fixture(scope="session")
def silver(spark, raw_dir, embeddings_raw):
    from corpweave.operators.standardise import standardise_embeddings, standardise_enrichment, standardise_registry
    from corpweave.operators.validate import good_rows
    from corpweave.sources.files import read_raw

    return {
        "registry": good_rows(standardise_registry(read_raw(spark, str(raw_dir / "dataset_1" / "part.json")))),
        "enrichment": good_rows(standardise_enrichment(read_raw(spark, str(raw_dir / "dataset_2" / "part.json")))),
        "embeddings": good_rows(standardise_embeddings(embeddings_raw, DIM)),
    }


@pytest.fixture(scope="session")
def gold(silver):
    from corpweave.operators.gold import to_gold
    from corpweave.operators.integrate import integrate

    return to_gold(integrate(silver["registry"], silver["enrichment"], silver["embeddings"])).cache()

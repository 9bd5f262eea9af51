import hashlib

import duckdb
import public_tokenizers
import pytest
import tiktoken

from corpweave.llm import bpe_pieces, plans

from .test_quality import brute as brute_statistics
from .test_secrets import brute_base

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_query_agrees_with_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "conversations", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = plans.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    cursor = duck.execute(plans.ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    assert got == sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in cursor.fetchall())


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    return {i: t or "" for i, t in rows}


def test_quality_and_secret_columns(spark, texts):
    for r in plans.op4_quality(spark, FOLDER).collect():
        stats = brute_statistics(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == stats
        failed = stats[0] < 50 or 100 * stats[4] > 50 * stats[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    for r in plans.op5_secrets(spark, FOLDER).collect():
        spans = brute_base(texts[r["doc_id"]])
        spelled = ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)
        assert r["base_sha256"] == hashlib.sha256(spelled.encode()).hexdigest()
        assert set(filter(None, spelled.split(","))) <= set(r["spans"].split(","))


def test_token_digests(spark, texts):
    ranks = bpe_pieces.read_ranks(open(plans.RANKS, "rb").read())
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = plans.op6_byte_bpe(spark, FOLDER).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        ids = plain.encode_ordinary(text)
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(data).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_toxicity_columns(spark, texts):
    rows = plans.op1_toxicity(spark, FOLDER).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)

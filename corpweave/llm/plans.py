"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.llm import bpe_pieces, chat, linedup, mixing, neighbours, packing, periodic, quality, secrets, simhash, toxicity
from corpweave.llm import variants, warc
from corpweave.llm.common import table

PACKING_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train_from(docs, table(spark, folder, "labels"))
    scored = toxicity.score_texts(docs, model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.PREDICT_AT).cast("int").alias("predicted"),
    )


def op2_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(rows, rows.where("vec_id % 20 = 0"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), Path(PACKING_VOCABULARY).read_text())


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.quality_verdicts(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("broken_rules", ",").alias("broken_rules"),
    )


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_digests(table(spark, folder, "documents"))


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_pieces.round_trip_digests(table(spark, folder, "documents"), Path(RANKS).read_bytes(), public_tokenizers.PATTERN)


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linedup.line_digests(table(spark, folder, "documents"))


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.digests(chat.expand_examples(turns.unionByName(control)))


def op10_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.resolve_revisits(warc.captures_of(table(spark, folder, "pages")))
    return found.select(
        "record_id", "resolved_id", "outcome", "status", F.md5("headers").alias("headers_md5"), F.md5("body").alias("body_md5")
    )


def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.run_digests(periodic.periodic_runs(table(spark, folder, "documents"), prepare=periodic.repeat_tail))


def op12_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.spelling_variants(table(spark, folder, "documents"), loses=97)


def op13_mixing(spark: SparkSession, folder: str) -> DataFrame:
    sizes = mixing.sized(table(spark, folder, "documents"))
    return mixing.mix_counts(sizes, mixing.repetitions(sizes))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_toxicity, op2_neighbours, op3_packing, op4_quality, op5_secrets, op6_byte_bpe, op7_simhash,
              op8_line_dedup, op9_chat, op10_revisits, op11_runs, op12_variants, op13_mixing)
}

ORACLES: dict[str, str] = {}

ORACLES["op8_line_dedup"] = r"""
WITH docs AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                     generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
              FROM documents),
keyed AS (SELECT *, translate(trim(line, E' \t\n\x0b\f\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM docs),
common AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
           GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.*, c.key IS NOT NULL AND c.keeper <> k.doc_id AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_TAILS = r"(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|/?SYS>>)"
ORACLES["op9_chat"] = rf"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
numbered AS (SELECT *, row_number() OVER talk AS n, count(*) OVER (PARTITION BY conv_id) AS m FROM turns
             WINDOW talk AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
written AS (SELECT *, length('<|im_start|>' || role || chr(10)
              || regexp_replace(text, '([<\[])(\\*){_TAILS}', '\1\2\\\3', 'g') || '<|im_end|>' || chr(10)) AS chars,
              role = 'assistant' OR n = m AS ends FROM numbered),
counted AS (SELECT *, count(*) FILTER (WHERE ends) OVER (PARTITION BY conv_id ORDER BY n DESC) AS examples FROM written)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars * examples) AS BIGINT) AS formatted_chars
FROM counted GROUP BY conv_id
"""

ORACLES["op10_revisits"] = r"""
WITH p AS (SELECT *, (page_id * 7919) % 10000019 AS t0, 'http://' || regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) || '/' AS front,
                  '"' || substr(md5(html), 1, 12) || '"' AS tag,
                  'day ' || CAST(((page_id * 7919) % 10000019) // 86400 AS VARCHAR) AS day FROM pages),
responses AS (SELECT page_id * 4 AS record_id, url AS uri, t0 AS t, tag, day, html FROM p WHERE page_id % 40 <> 7
              UNION ALL SELECT page_id * 4 + 1, front, t0, tag, day, html FROM p WHERE page_id % 50 = 0),
revisits AS (SELECT page_id * 4 + 2 AS record_id,
               CASE WHEN page_id % 3 = 1 THEN front ELSE regexp_replace(url, '#.*$', '')
                 || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'utm_source=again#x' END AS uri,
               t0 + CASE WHEN page_id % 5 = 0 THEN -21600 ELSE 21600 END AS t,
               CASE WHEN page_id % 3 = 1 THEN NULL WHEN page_id % 7 = 0 THEN '"stale"'
                    WHEN page_id % 7 IN (1, 2) THEN NULL ELSE tag END AS tag,
               CASE WHEN page_id % 3 <> 1 AND page_id % 7 = 2 THEN day END AS day
             FROM p WHERE page_id % 3 <> 0),
bare AS (SELECT *, regexp_replace(regexp_replace(trim(uri), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b
         FROM (SELECT record_id, uri, t, tag, day, TRUE AS asks FROM revisits
               UNION ALL SELECT record_id, uri, t, tag, day, FALSE FROM responses)),
cut AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '') AS host,
          regexp_extract(b, '^[^/?]*([^?]*)', 1) AS path,
          array_to_string(list_sort([x FOR x IN string_split(regexp_extract(b, '\?(.*)$', 1), '&')
            IF x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)=')]), '&') AS q FROM bare),
keyed AS (SELECT *, host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN q = '' THEN '' ELSE '?' || q END AS key
          FROM cut WHERE host <> ''),
found AS (SELECT record_id, asks, tag, day, last_value(CASE WHEN NOT asks THEN record_id END IGNORE NULLS)
            OVER (PARTITION BY key ORDER BY t, asks DESC, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen
          FROM keyed),
judged AS (SELECT f.record_id, f.tag, f.day, r.record_id AS seen, r.tag AS rtag, r.day AS rday, r.html,
             CASE WHEN r.record_id IS NULL THEN 'no_response'
                  WHEN f.tag IS NULL AND f.day IS NULL THEN 'resolved_unchecked'
                  WHEN f.tag IS NOT NULL THEN CASE WHEN f.tag = r.tag THEN 'resolved' ELSE 'validator_mismatch' END
                  WHEN f.day = r.day THEN 'resolved' ELSE 'validator_mismatch' END AS outcome
           FROM found f LEFT JOIN responses r ON r.record_id = f.seen WHERE f.asks),
nl AS (SELECT chr(13) || chr(10) AS e)
SELECT record_id, CASE WHEN outcome LIKE 'resolved%' THEN seen END AS resolved_id, outcome,
       CASE WHEN outcome LIKE 'resolved%' THEN 200 END AS status,
       CASE WHEN outcome LIKE 'resolved%' THEN md5('Content-Type: text/html'
         || CASE WHEN tag IS NULL THEN e || 'ETag: ' || rtag ELSE '' END
         || CASE WHEN day IS NULL THEN e || 'Last-Modified: ' || rday ELSE '' END || e || 'Server: s'
         || e || 'Date: now' || e || 'Cache-Control: max-age=60'
         || CASE WHEN tag IS NOT NULL THEN e || 'etag: W/' || tag WHEN day IS NOT NULL THEN e || 'last-modified: ' || day ELSE '' END)
       END AS headers_md5,
       CASE WHEN outcome LIKE 'resolved%' THEN md5(html) END AS body_md5
FROM judged, nl
"""

ORACLES["op13_mixing"] = r"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                      coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS name FROM documents),
weighed AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY 3 * source_size / w, source NULLS LAST) AS k FROM weighed),
ahead AS (SELECT *, sum(source_size) OVER () - coalesce(3 * sum(source_size) OVER before, 0) AS rest,
                 sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS shares
          FROM ranked WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT * FROM ahead WHERE w * rest <= 3 * source_size * shares ORDER BY k LIMIT 1),
aimed AS (SELECT a.source, a.source_size, CASE WHEN a.k < l.k THEN CAST(3 * a.source_size AS DOUBLE)
                 ELSE CAST(a.w * l.rest AS DOUBLE) / CAST(l.shares AS DOUBLE) END AS target FROM ahead a, level l),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM aimed),
drawn AS (SELECT s.*, r.source_size, r.target, seed, CAST(floor(rate) AS BIGINT) + CASE WHEN
            CAST(CAST('0x' || substr(md5(seed || ':' || name), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 < rate - floor(rate)
            THEN 1 ELSE 0 END AS times
          FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source, range(32) t(seed)),
tried AS (SELECT source, seed, abs(CAST(sum(size * times) AS DOUBLE) - first(target)) AS miss FROM drawn GROUP BY source, seed),
chosen AS (SELECT source, seed FROM tried QUALIFY row_number() OVER (PARTITION BY source ORDER BY miss, seed) = 1)
SELECT doc_id, size, source_size, target, size * times AS taken
FROM drawn d JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source AND d.seed = c.seed
"""

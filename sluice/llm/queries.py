"""The registered queries of this folder: thin calls of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import (
    alignment,
    archive,
    codes,
    decontamination,
    embeddings,
    langid,
    lm,
    packing,
    quality,
    recompression,
    simhash,
    suffixes,
    toxicity,
)
from sluice.llm.common import table
from sluice.session import scratch_path

QUERIES: dict = {}
SQL: dict[str, str] = {}


def tokenizer_files() -> dict[str, str]:
    import public_tokenizers as public

    return {
        "tokenizer": public.path("byte_bpe_50k.json"),
        "ranks": public.path("byte_bpe_50k.tiktoken"),
        "pattern": public.PATTERN,
    }


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    archive.write_archive(table(spark, sf_dir, "pages"), path)
    return archive.summary(archive.read_archive(spark, path))


# DuckDB: SHA-1 in hex, five digits a group, four letters each.
SQL["op4_warc"] = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS h
  FROM pages),
t AS (SELECT h, max(page_id) AS top FROM p GROUP BY h)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(p.h, 1 + 5 * CAST(i // 4 AS INTEGER), 5) AS INTEGER)
                     >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM p JOIN t USING (h)
"""


@query
def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), **tokenizer_files())


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3)


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


@query
def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window that holds an item; documents without one are clean."""
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("digest")


@query
def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.95)


@query
def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicate(table(spark, sf_dir, "documents"), width=50)


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return alignment.align(
        table(spark, sf_dir, "documents"), model=public.path("piece_bpe_32k.model"), **tokenizer_files()
    )


@query
def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.fit(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6).summary()


def _codes_sql(rounds: int) -> str:
    """The rounds written out: each assigns all parts and moves the entries."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, part, any_value(p.x) AS x,
         min({{'d': CAST(list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT),
              'e': entry}}) AS m
  FROM p JOIN c{r} c USING (part) GROUP BY vec_id, part)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(n.x, c.x) AS x
  FROM c{r} c LEFT JOIN (
    SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY k) AS x
    FROM (SELECT part, m.e AS entry, k, CAST(sum(x[k]) AS BIGINT) AS s, count(*) AS n
          FROM a{r}, range(1, 9) t(k) GROUP BY ALL)
    GROUP BY part, entry) n ON n.part = c.part AND n.entry = c.entry)""")
    return f"""
WITH v AS (
  SELECT vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT vec_id, label, part, x[8 * part + 1 : 8 * part + 8] AS x FROM v, range(8) t(part)),
c0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x
  FROM p QUALIFY entry < 16),{",".join(steps)},
found AS (
  SELECT vec_id, string_agg(printf('%02x', m.e), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id),
book AS (
  SELECT sha256(string_agg(CAST(x[k] AS VARCHAR), ',' ORDER BY part, entry, k)) AS digest
  FROM c{rounds}, range(1, 9) t(k))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       digest AS codebooks_sha256
FROM found JOIN v USING (vec_id), book
"""


# Parts of eight components, as the tables have 64.
SQL["op11_codes"] = _codes_sql(6)


@query
def op12_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.deduplicate(table(spark, sf_dir, "documents"), width=20)


SQL["op12_recompression"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (
  SELECT doc_id, s, array_to_string(words[s : s + 19], ' ') AS g
  FROM d, unnest(range(1, greatest(len(words) - 18, 1))) t(s)),
later AS (SELECT doc_id, s FROM w QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, s + k AS p FROM later, range(20) t(k)),
each AS (SELECT doc_id, p, words[p] AS word FROM d, unnest(range(1, len(words) + 1)) t(p)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

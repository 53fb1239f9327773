"""The registered queries on the given tables: SQL where there is some, else their shape."""

import oracle
import pytest

import __spark_entry__ as entry
from sluice.llm.queries import QUERIES, SQL

COLUMNS = {
    "op1_pack": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op2_embeddings": "vec_id n_links component_id kept",
    "op3_quality": "doc_id held_out expected_grade tail_probability selected",
    "op4_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op5_decontamination": "doc_id item_id start n_words similarity",
    "op6_suffixes": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op7_toxicity": "doc_id held_out score predicted",
    "op8_language": "doc_id held_out lang_pred score cosine",
    "op9_simhash": "doc_id fingerprint component_id kept",
    "op13_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op11_codes": "vec_id code error label_error codebooks_sha256",
    "op12_recompression": "doc_id n_words n_removed kept_sha256",
    "op10_lm": "doc_id held_out n_tokens n_known train_tokens base_score score",
}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS) and set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(SQL))
def test_matches_sql(spark, sf_dir, name):
    assert oracle.differences(QUERIES[name](spark, sf_dir), SQL[name], oracle.connect(sf_dir)) is None


@pytest.mark.parametrize("name", [n for n in COLUMNS if n not in SQL and n not in ("op1_pack", "op5_decontamination")])
def test_a_row_for_every_row(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns == COLUMNS[name].split()
    source = "embeddings" if name == "op2_embeddings" else "documents"
    key = "vec_id" if name == "op2_embeddings" else "doc_id"
    ids = sorted(r[0] for r in df.select(key).collect())
    assert ids == sorted(r[0] for r in spark.read.parquet(f"{sf_dir}/{source}.parquet").select(key).collect())


def test_leaks_are_named(spark, sf_dir):
    df = QUERIES["op5_decontamination"](spark, sf_dir)
    assert df.columns == COLUMNS["op5_decontamination"].split()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id) for r in df.collect()}
    verbatim = {(d, i) for d, text in docs.items() for i, item in items.items() if item in (text or "")}
    assert verbatim and verbatim <= found

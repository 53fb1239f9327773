"""The corpus pipeline: each stage works on what its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)``; all but the last return the
columns of documents. Null and empty texts pass the filters (one of the texts
without words stays), repeated rows are one group of near-duplicates, and an
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontamination, packing, simhash, suffixes, toxicity
from sluice.llm.common import keep, table
from sluice.llm.queries import tokenizer_files


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones here, does not reject."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within three bits of each other, by chains."""
    return simhash.survivors(docs, words=3, max_bits=3)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte strings that a document with a smaller id has.

    All documents stay, some of them empty (a null text becomes empty);
    ``n_chars`` is that of the new text.
    """
    # The other columns ride along as one, so that no name clashes.
    rows = docs.select("doc_id", "text", F.struct("*").alias("row"))
    rows = rows.withColumn("row", F.col("row").dropFields("text"))
    cut = suffixes.deduplicate(rows, width=50, with_text=True, carry=["row"])
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return cut.select(*(new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return packing.pack(docs, **tokenizer_files())


STAGES = [
    ("toxicity", without_toxic),
    ("simhash near-dedup", without_near_copies),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL can express neither the classifier nor the tokenizer; tests hold each
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

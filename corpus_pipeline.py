"""Training-data pipeline over ``documents``.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and works on
all rows its predecessor kept. :func:`run` writes every stage's result below the shared checkpoint
folder as Parquet and reads it back as the next one's ``docs``. All stages but the last return the
columns of ``documents``. An empty table gives an empty result; nulls, repeated rows and extra
columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigmawatch.llm import apportion, bpe_fst, pii_anchors, simhash_golay, toxicity_fm
from sigmawatch.llm.common import materialise, read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not predict as toxic."""
    # The columns wait in a struct: one of them may be named like a result.
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))
    scored = toxicity_fm.toxicity(rows, read_table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 0").select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-copies."""
    return simhash_golay.deduplicate(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii_anchors.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return apportion.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, as little-endian unsigned 32-bit integers."""
    return bpe_fst.encode(docs).select("doc_id", "source", "n_tokens", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("pii", redact_pii),
    ("mix", mix_sources),
    ("bpe", tokenize),
]

#: No stage but the mix can be said in SQL; the pipeline is tested against brute-force stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

"""Corpus pipeline: filtering stages of the training-data operators, ending in packed sequences.

1. toxicity: documents predicted toxic go;
2. near duplicates: one document of each class stays;
3. benchmark decontamination: documents that hold a benchmark item go;
4. secret scan: secrets are replaced in the text (``n_chars`` counted anew);
5. packing: the documents left become pieces of sequences.

Each stage is (name, function); a function takes (spark, docs, sf_dir), works on
all its predecessor kept and returns a DataFrame, all but the last with the columns
of ``documents``.  ``run`` writes each stage's rows as Parquet to the shared
checkpoint folder and rereads them as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontamination, near_duplicates, packing, secrets, toxicity
from tessera.llm.common import release, table, written
from tessera.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    release(spark)
    return toxicity.filter_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    release(spark)
    return near_duplicates.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    release(spark)
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    release(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scan", redact_secrets),
    ("packing", pack),
]

#: Trained models, simulated hashes and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the last stage makes of the documents kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

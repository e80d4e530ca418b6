"""The training-data pipeline over ``documents``: five stages, each one numbered operator.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. Its result is written
below the shared folder and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.llm import decontam, packing, simhash, substring, toxicity
from statlake.llm.common import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic.

    The model is fitted on the labelled rows of ``docs``. The score depends on the text alone, so rows
    without id and repeated rows are judged too; null and empty texts hold no feature.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = written(toxicity.labelled(docs, labels, "toxic"), "toxic-rows")
    return toxicity.without_toxic(docs, toxicity.fit(learn))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked fingerprints the document of smallest id, of rows of equal id and text one.

    Shingles of three words and at most three differing bits, as in the operator's own query. A document
    without id stays only if no document of its component has one; texts without words are one component.
    """
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a document of smaller id has too are cut out of the text."""
    cut = substring.deduplicated(docs)
    if "n_chars" not in docs.columns:
        return cut
    kind = docs.schema["n_chars"].dataType
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", one_of_each),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: The first, fourth and fifth stage have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

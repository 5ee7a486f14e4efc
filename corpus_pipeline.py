"""A training corpus from raw documents, in five stages.

Each stage is a function of the session, the documents its predecessor kept and the folder of the tables. Its result is
written as Parquet and read again as the next one's documents. All but the last return the columns of ``documents``;
the last adds ``copies``, how often the mix takes a document.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.llm import decontaminate, mixing, near_dups, quality, surrogates
from shoptrail.session import delete_folder, work_folder

KEY = "corpus-pipeline"

# Its rows come from a trained classifier, so SQL cannot state them.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts; it is fitted on labelled rows of ``docs`` outside the held-out fifth."""
    model = quality.fit_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    free = "_" * (1 + max(map(len, docs.columns)))  # longer than any column, so none of that name
    scored = quality.score(docs, model, name=f"{free}score", decided=f"{free}good")
    return scored.filter(F.col(f"{free}good") == 1).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one of the smallest id."""
    return near_dups.without_near_duplicates(docs)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def with_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; ``n_chars`` follows the new text."""
    replaced = surrogates.pseudonymised(docs, KEY)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("replaced") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
        replaced = replaced.withColumn("n_chars", changed)
    return replaced.select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, and how often."""
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", one_of_each_group),
    ("benchmark decontamination", not_in_benchmark),
    ("PII", with_surrogates),
    ("mixing sources to target weights", mixed_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, for the table ``documents`` of a folder. A stage's files go when the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        result, folder = stage(spark, docs, sf_dir), work_folder(spark, "pipeline")
        result.write.parquet(folder)
        docs = spark.read.schema(result.schema).parquet(folder)
        if before:
            delete_folder(spark, before)
        before = folder
    return docs

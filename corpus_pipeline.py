"""From raw documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
it kept. All but the last return the columns of ``docs``.
"""

from pyspark.sql import DataFrame, SparkSession

from segue.llm import decontaminate, mixing, near_dups, quality, token_files
from segue.llm.queries import END_ID, tokenizer
from segue.sources.storage import scratch_path, stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the smallest id."""
    return near_dups.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than a twentieth of their words in benchmark passages."""
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return mixing.mix_rows(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as they are read back from the token files, in file order."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(docs, path, tokenizer("word_bpe_49k.json"), END_ID)
    return token_files.read_token_files(spark, path)


STAGES = [
    ("quality classifier", quality_classifier),
    ("near duplicates", near_dedup),
    ("benchmark decontamination", decontamination),
    ("source mixing", mix_sources),
    ("token output", token_output),
]

# Classifier, near duplicates and token ids are beyond SQL; tests/llm compares
# the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

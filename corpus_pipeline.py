"""A training corpus from the documents table, stage by stage.

Each stage takes what the stage before kept, is written as Parquet and read again.  All but the last
return documents with all their columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from accordance.llm import op1_mixing, op5_winnowing, op6_weak_toxicity, op8_token_file, op9_lsh_forest
from accordance.llm.queries import END_ID, TOKENIZER
from accordance.llm.tables import new_path, table

#: Passes of the source that is repeated most.
MAX_PASSES = 1.5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    return op6_weak_toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar documents stays."""
    return op9_lsh_forest.one_of_each_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return op5_winnowing.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of small sources are repeated; each stays at least once."""
    return op1_mixing.mixed(docs, max_passes=MAX_PASSES).select("row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID files; one row for each document in them, as read back."""
    return op8_token_file.tokenized(docs, op8_token_file.word_ids(TOKENIZER, END_ID))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_ids", token_ids),
]

#: No SQL: classifier, exact similarity classes over all texts and tokenizer are beyond it.  The tests compare run()
#: with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

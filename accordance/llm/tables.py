"""Reading the tables of a folder, and keeping results that several plans use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of these characters; A-Z are lower-cased before.  This is [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ said without
#: a negation, with which Java takes eight times as long.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
BATCH_BYTES, SPARKS_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; a local master may do with a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}/{name}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    Later plans start from the files, also after an executor is lost, and Spark knows their size.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Python tasks of the session get at most 8 MB of rows at a time, unless it has a size of its own.

    Spark's default is 64 MB: with texts, a batch then takes several times that in a task and its Python worker, which neither gives back.
    """
    if spark.conf.get(BATCH_BYTES) == SPARKS_BATCH:
        spark.conf.set(BATCH_BYTES, "8m")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text, none for null."""
    found = F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))

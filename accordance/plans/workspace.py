"""The folder all executors share, for differences that are used more than once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from accordance.model import ConfigError, Pairs
from accordance.operators.rows import digest_diff, row_diff


#: Digests that every task can hold, in about 20 MB.
FEW_DIGESTS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ConfigError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/accordance/{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """The frame written to the shared folder, or to one in it, and read back.

    What reads the result does not run the comparison again, also not after an executor
    is lost.
    """
    path = f"{folder}/{name}" if folder else new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_row_diff(
    source: DataFrame, target: DataFrame, mapping: Pairs | None = None, folder: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """``row_diff`` in two steps, and the stored digests: only digests are shuffled, then only differing rows."""
    digests = stage(digest_diff(source, target, mapping), f"digests-{uuid.uuid4().hex}", folder)
    return rows_of_digests(source, target, mapping, digests), digests


def rows_of_digests(
    source: DataFrame, target: DataFrame, mapping: Pairs | None, digests: DataFrame
) -> DataFrame:
    """``row_diff`` by stored digests if they are few; of tables that differ all over, by their rows at once."""
    few = digests.limit(FEW_DIGESTS + 1).count() <= FEW_DIGESTS
    return row_diff(source, target, mapping, digests if few else None)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove what was staged in a folder, wherever Spark keeps it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def local_rows(df: DataFrame) -> DataFrame:
    """The few rows of a preview, kept without the files they come from."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)

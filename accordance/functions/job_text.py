"""The text columns of a jobs table, unfolded for all jobs in one query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_mappings(jobs: DataFrame, column: str = "column_mapping") -> DataFrame:
    """One row per mapped pair: ``job_name, pos, src, tgt, valid``.

    Jobs without a mapping give no row.  A piece that is not ``source:target`` is kept with
    ``valid = false``, so that one query shows all faults of the table.
    """
    pieces = jobs.where(F.trim(column) != "").select(
        "job_name", F.posexplode(F.split(column, ",")).alias("pos", "piece")
    )
    parts = F.split("piece", ":")
    src, tgt = F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))
    valid = (F.size(parts) == 2) & (src != "") & F.coalesce(tgt != "", F.lit(False))
    return pieces.select(
        "job_name", "pos", src.alias("src"), tgt.alias("tgt"), valid.alias("valid")
    )


def explode_checks(jobs: DataFrame, column: str = "checks") -> DataFrame:
    """One row per job and check, in listed order: ``job_name, pos, recon_type``."""
    return jobs.select(
        "job_name", F.posexplode(F.split(column, ",")).alias("pos", "piece")
    ).select("job_name", "pos", F.lower(F.trim("piece")).alias("recon_type"))

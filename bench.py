"""Times the headline queries and prints one JSON line.

``queries`` are this library's plans.  ``reference_shape`` repeats, in PySpark, the way a
check is evaluated without them: set differences counted for the test and again for the message,
three evaluations where the sides differ, and a full outer join run for two counts, the write and
the preview.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import accordance as ac
from accordance.operators.cells import keys_not_unique
from accordance.operators.rows import only_counts
from accordance.plans.runner import FEW_KEYS
from accordance.plans.workspace import stage
from showcase import queries as q

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def rows_check(source: DataFrame, target: DataFrame, mapping) -> None:
    """What the runner does: digests, stored and counted, then the rows of those that differ, stored and previewed."""
    rows, digests = ac.stage_row_diff(source, target, mapping)
    if any(digests.agg(*only_counts()).first()):
        ac.preview(stage(rows, "rows"), 20).collect()


def cells_check(source: DataFrame, target: DataFrame, mapping, keys) -> None:
    duplicates = stage(keys_not_unique(source, target, mapping, keys), "duplicates")
    n = duplicates.limit(FEW_KEYS + 1).count()
    how = {"duplicates": duplicates, "few_duplicates": n <= FEW_KEYS} if n else {"unique_keys": True}
    cells = stage(ac.cell_diff(source, target, mapping, keys, **how), "cells")
    cells.count()
    ac.stratified_preview(cells, 10).collect()


def keys_check(source: DataFrame, target: DataFrame, keys) -> None:
    diff = stage(ac.key_diff(source, target, keys), "keys")
    diff.groupBy("kind").count().collect()


def rows_shape(source: DataFrame, target: DataFrame, mapping) -> None:
    source = ac.align_source_to_target(source, mapping)
    target = target.select(source.columns)
    # The test stops at the first difference; the message counts both again.
    source.exceptAll(target).count()
    source.exceptAll(target).count()
    target.exceptAll(source).count()


def cells_shape(source: DataFrame, target: DataFrame, mapping, keys) -> None:
    target = ac.align_target_to_source(target, mapping)
    names = [k for k, _ in keys]
    s, t = source.alias("s"), target.alias("t")
    on = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in names]
    details = [
        F.when(
            ~F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")),
            F.concat(F.lit(f"{c}:"), F.col(f"s.{c}"), F.lit("!="), F.col(f"t.{c}")),
        )
        for c, _ in mapping
        if c not in names
    ]
    joined = s.join(t, on, "full_outer").select(
        *[F.col(f"s.{c}").alias(f"s_{c}") for c in source.columns],
        *[F.col(f"t.{c}").alias(f"t_{c}") for c in target.columns],
        F.concat_ws(",", *details).alias("details"),
    ).where("details <> ''")
    joined.count()
    joined.count()
    stage(joined, "joined")
    joined.limit(10).collect()


def keys_shape(source: DataFrame, target: DataFrame, keys) -> None:
    source = source.select([F.col(s).alias(t) for s, t in keys])
    target = target.select([t for _, t in keys])
    source.subtract(target).count()
    source.subtract(target).count()
    target.subtract(source).count()


def best_of(times: int, work) -> float:
    taken = []
    for _ in range(times):
        start = time.perf_counter()
        work()
        taken.append(time.perf_counter() - start)
    return round(min(taken), 3)


def main() -> None:
    spark = session()
    orders, lines = q.orders_pair(spark, SF_DIR), q.lines_pair(spark, SF_DIR)
    # Every order once on each side, as a table with a primary key has it.
    unique = orders[0], orders[1].dropDuplicates(["order_id"])
    mapping, keys = q.ORDERS_MAPPING, q.ORDERS_KEYS
    line_columns = [(c, c) for c in lines[0].columns]
    checks = {
        "rows_orders": (rows_check, rows_shape, (*orders, mapping)),
        "rows_lines": (rows_check, rows_shape, (*lines, line_columns)),
        "cells_orders": (cells_check, cells_shape, (*orders, mapping, keys)),
        "cells_orders_unique": (cells_check, cells_shape, (*unique, mapping, keys)),
        "cells_lines": (cells_check, cells_shape, (*lines, q.LINES_MAPPING, q.LINES_KEYS)),
        "keys_orders": (keys_check, keys_shape, (*orders, keys)),
        "keys_lines": (keys_check, keys_shape, (*lines, q.LINES_KEYS)),
    }
    timed = {
        name: best_of(3, lambda: check(*arguments))
        for name, (check, _, arguments) in checks.items()
    }
    shapes = {
        name: best_of(3, lambda: shape(*arguments))
        for name, (_, shape, arguments) in checks.items()
    }
    single = [
        "s2t_cells_of_hot_keys",
        "row_diff_of_documents",
        "diff_summary",
        "record_count",
        "threshold",
        "schema_drift",
        "rule_join_agg",
        "rule_vs_target",
    ]
    for name in single:
        timed[name] = best_of(3, lambda: run(q.QUERIES[name](spark, SF_DIR)))
    print(
        json.dumps(
            {
                "metric": "total_time_of_checks",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "reference_shape": shapes,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

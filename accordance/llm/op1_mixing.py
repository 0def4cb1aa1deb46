"""Mixing sources to target weights: temperature mixing.

The weight of source s is its share of tokens to the power of an exponent: w = p^a / sum p^a.  a = 1 keeps
the shares, a = 0 makes all sources equal.  The exponent is found by bisection, either so that the entropy of the
weights reaches a target or so that no source is repeated more than a limit.  The token budget is the smallest with
which every source passes once, so no document is lost: the source with the largest share passes once and others
are repeated, the last time in part.

A budget is met by permutations of blocks.  The documents of a source are dealt by hash into blocks of about
``BLOCK_ROWS``; each pass takes the blocks in an order of its own and each block's documents in an order of their own, until the
budget is spent.  A document's place is its tokens before it by the budget of the source, from 0 to 1,
so that rows sorted by place hold all sources at their weights everywhere.

Bisection evaluates many exponents in one aggregation over the table of sources, which never is collected.  Windows
run over the blocks of a source and over the documents of a block, so that a hot source is spread over its blocks.

Defined results: a null source counts as the source ''.  A null or empty text has no tokens and its document passes
as often as its place says.  Sources without tokens pass once.  Repeated rows are documents of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from accordance.llm.tables import keep

BLOCK_ROWS = 4096
#: Exponents tried at a time, and rounds; the exponent is known to STEPS ** -ROUNDS.
STEPS, ROUNDS = 32, 5


def token_count(text: Column) -> Column:
    """Runs of characters between white space."""
    trimmed = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(
        text.isNull() | (trimmed == ""), 0
    ).otherwise(F.length(trimmed) - F.length(F.translate(trimmed, " ", "")) + 1).cast("long")


def source_totals(docs: DataFrame) -> DataFrame:
    """mix_source, tokens, docs and share of each source."""
    totals = keep(
        docs.groupBy("mix_source").agg(F.sum("mix_tokens").alias("tokens"), F.count("*").alias("docs")), "sources"
    )
    whole = totals.agg(F.sum("tokens").alias("all_tokens"))
    return totals.crossJoin(F.broadcast(whole)).select(  # one row
        "mix_source",
        "tokens",
        "docs",
        F.when(F.col("all_tokens") > 0, F.col("tokens") / F.col("all_tokens")).otherwise(0.0).alias("p"),
    )


def _tried(totals: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """Entropy of the weights and the largest number of passes at each exponent."""
    p = F.col("p")
    columns = [F.min("p").alias("least"), F.max("p").alias("most")]
    for n, a in enumerate(exponents):
        columns += [
            F.sum(F.pow(p, F.lit(a))).alias(f"z{n}"),
            F.sum(F.pow(p, F.lit(a)) * F.log(p)).alias(f"s{n}"),
        ]
    row = totals.where("p > 0").agg(*columns).first()
    if row["least"] is None:
        return [(0.0, 1.0) for _ in exponents]
    return [
        (math.log(row[f"z{n}"]) - a * row[f"s{n}"] / row[f"z{n}"], (row["least"] / row["most"]) ** (a - 1))
        for n, a in enumerate(exponents)
    ]


def find_exponent(
    totals: DataFrame, entropy: float | None = None, max_passes: float | None = None
) -> float:
    """The largest exponent in [0, 1] with at least this entropy, or the smallest with at most so many passes.

    If both are given, the limit of passes goes before the entropy.
    """

    def bisect(enough) -> tuple[float, float]:
        """Between which exponents ``enough`` turns from true to false."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            grid = [low + (high - low) * n / STEPS for n in range(STEPS + 1)]
            good = [enough(*x) for x in _tried(totals, grid)]
            n = max(sum(good) - 1, 0)
            low, high = grid[n], grid[min(n + 1, STEPS)]
        return low, high

    found = 0.0 if entropy is None else bisect(lambda h, _: h >= entropy - 1e-12)[0]
    if max_passes is not None:
        if _tried(totals, [found])[0][1] <= max_passes:
            return found
        low, high = bisect(lambda _, r: r > max_passes)
        return max(found, high if low < high else low)
    return found


def budgets(docs: DataFrame, entropy: float | None = None, max_passes: float | None = 1.5) -> DataFrame:
    """mix_source, tokens, blocks, passes, budget (tokens) of each source; docs have mix_source and mix_tokens."""
    totals = keep(source_totals(docs), "totals")
    a = find_exponent(totals, entropy, max_passes)
    most = totals.agg(F.max("p").alias("most"))
    passes = F.when(F.col("p") > 0, F.pow(F.col("p") / F.col("most"), F.lit(a - 1.0))).otherwise(1.0)
    return keep(
        totals.crossJoin(F.broadcast(most))  # one row
        .withColumn("passes", passes)
        .select(
            "mix_source",
            "tokens",
            "passes",
            F.ceil(F.col("docs") / BLOCK_ROWS).cast("int").alias("blocks"),
            F.greatest("tokens", F.floor(F.col("tokens") * F.col("passes"))).cast("long").alias("budget"),
        ),
        "budgets",
    )


def _order(*parts) -> Column:
    return F.xxhash64(*parts)


def mixed(
    docs: DataFrame, entropy: float | None = None, max_passes: float | None = 1.5, seed: int = 1
) -> DataFrame:
    """The rows of docs (column ``row``) as often as they are taken.

    Also mix_source, mix_tokens, mix_epoch (which pass) and mix_place; docs have doc_id, text and source.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("mix_source"),
        token_count(F.col("text")).alias("mix_tokens"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("mix_key"),
    )
    narrow = keep(rows.select("mix_source", "mix_tokens", "mix_key"), "tokens")
    plan = budgets(narrow, entropy, max_passes)
    block = F.pmod(F.xxhash64("mix_key", F.lit(seed)), F.col("blocks")).cast("int")
    taken = plan.select(
        F.col("mix_source").alias("_source"), "tokens", "blocks", "budget", F.ceil("passes").cast("int").alias("last")
    )
    # Tokens of the blocks, and what comes before each in each pass.
    blocks = (
        narrow.join(taken, F.col("mix_source") == F.col("_source"))
        .withColumn("block", block)
        .groupBy("mix_source", "block", "last", "tokens", "budget")
        .agg(F.sum("mix_tokens").alias("held"))
        .withColumn("mix_epoch", F.explode(F.sequence(F.lit(1), F.col("last"))))
    )
    order = Window.partitionBy("mix_source", "mix_epoch").orderBy(_order(F.lit(seed), "mix_epoch", "block"), "block")
    before = F.coalesce(F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = keep(
        blocks.withColumn("start", before + (F.col("mix_epoch") - 1) * F.col("tokens"))
        .where((F.col("start") < F.col("budget")) | (F.col("mix_epoch") == 1))
        .select(F.col("mix_source").alias("_own"), F.col("block").alias("_block"), "mix_epoch", "start", "budget"),
        "blocks",
    )
    dealt = rows.join(taken.select("_source", "blocks"), F.col("mix_source") == F.col("_source")).withColumn(
        "_in", block
    )
    each = dealt.join(blocks, (F.col("mix_source") == F.col("_own")) & (F.col("_in") == F.col("_block")))
    inner = Window.partitionBy("mix_source", "_in", "mix_epoch").orderBy(
        _order(F.lit(seed), "mix_epoch", "mix_key"), "mix_key"
    )
    before = F.coalesce(F.sum("mix_tokens").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = F.col("start") + F.col("_ahead")
    return (
        each.withColumn("_ahead", before)
        .where((at < F.col("budget")) | (F.col("mix_epoch") == 1))
        .withColumn("mix_place", F.when(F.col("budget") > 0, at / F.col("budget")).otherwise(0.0))
        .select("row", "mix_source", "mix_tokens", "mix_epoch", "mix_place")
    )

"""Benchmark decontamination by winnowing.

An item's windows are its runs of ``window`` words; an item of fewer words is one window.  A shared
run of t words holds t - k + 1 k-grams.  Texts and items keep the smallest k-gram hash of every
t - k + 1 neighbouring k-grams (of equal hashes the leftmost), so that both keep the same k-gram of
every shared run: none is missed.  Kept fingerprints are joined for membership only, each hit is extended to the
windows around it, and windows are compared by their words; so no pairs of chance hits arise, and
the result is exact.  Items shorter than the window have fingerprints of their own length.

Everything is built-in functions.  Spark broadcasts fingerprints and windows of the items by
their stored size and shuffles them beyond its threshold; a hot fingerprint is then split.

Defined results: texts are told apart by doc_id and text, so rows with one doc_id but other texts
are judged apart, and equal rows get equal results.  A null or empty text has no words; an item
without words or with a null item_id has no windows.  Items may repeat; each item_id counts once.  Extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordance.llm.tables import keep, words_of

#: The lower bits of a fingerprint are its place: a text of 2 GB has under 2^30 words.
PLACE_BITS = 30


def gram_of(t: int) -> tuple[int, int]:
    """Words of a k-gram and k-grams of a winnowing window for shared runs of t words."""
    k = 4 if t >= 4 else 2 if t >= 2 else 1
    return k, t - k + 1


def _paired(name: str, by: int, size: Column) -> tuple[Column, Column]:
    """Elements and those ``by`` places later, for an array of ``size + by`` elements."""
    size = F.greatest(size, F.lit(0))
    return F.slice(name, F.lit(1), size), F.slice(name, F.lit(1 + by), size)


def _of_length(t: int):
    """A function of one parameter, so that transform passes no index."""
    return lambda v: F.struct(F.lit(t).alias("t"), v.alias("v"))


def fingerprints(rows: DataFrame, lengths: list[int], *keys: str) -> DataFrame:
    """keys, t, place, print: for each t the fingerprints of the column words.

    Each step is a column of its own, since an expression that is used twice is evaluated twice.
    """
    place = F.lit((1 << PLACE_BITS) - 1)
    n = F.col("n")
    out = rows.select(
        *keys,
        F.size("words").alias("n"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("g1"),
    )
    for k in (2, 4):
        if k <= max(gram_of(t)[0] for t in lengths):
            half = k // 2
            pairs = _paired(f"g{half}", half, n - (k - 1))
            out = out.withColumn(f"g{k}", F.zip_with(*pairs, lambda x, y: F.xxhash64(x, y)))
    for t in lengths:
        k, width = gram_of(t)
        out = out.withColumn(
            f"m{t}",
            F.transform(
                f"g{k}",
                lambda h, i: h.bitwiseAND(F.bitwise_not(place)).bitwiseOR(i.cast("long")),
            ),
        )
        have = 1
        while have < width:
            step = min(have, width - have)
            have += step
            pairs = _paired(f"m{t}", step, n - (k - 1) - (have - 1))
            out = out.withColumn(f"m{t}", F.zip_with(*pairs, lambda x, y: F.least(x, y)))
        out = out.withColumn(f"m{t}", F.array_distinct(f"m{t}"))
    marks = [F.transform(f"m{t}", _of_length(t)) for t in lengths]
    found = out.select(*keys, F.explode(F.concat(*marks)).alias("x"))
    return found.select(
        *keys,
        "x.t",
        F.col("x.v").bitwiseAND(place).cast("int").alias("place"),
        F.col("x.v").bitwiseAND(F.bitwise_not(place)).alias("print"),
    )


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """item_id, words, t (words of its windows) of each item that has words."""
    words = items.select("item_id", words_of(F.col("text")).alias("words"))
    return words.where("item_id IS NOT NULL AND size(words) > 0").withColumn(
        "t", F.least(F.size("words"), F.lit(window))
    )


def _window(words: Column, start: Column, t: Column) -> Column:
    text = F.array_join(F.slice(words, start + 1, t), " ")
    return F.struct(start.alias("s"), t.alias("t"), text.alias("window"))


def _starts(lengths: list[int], size: Column) -> Column:
    """The windows (s, t) that hold the k words at any of ``places``."""
    def of(p: Column) -> Column:
        room = F.lit(0)
        for t in lengths:
            room = F.when(p["t"] == t, t - gram_of(t)[0]).otherwise(room)
        first = F.greatest(p["place"] - room, F.lit(0))
        last = F.least(p["place"], size - p["t"])
        starts = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda s: F.struct(s.alias("s"), p["t"].alias("t")))

    return F.array_distinct(F.flatten(F.transform("places", of)))


def window_hits(docs: DataFrame, items: DataFrame, window: int = 10) -> tuple[DataFrame, DataFrame]:
    """The windows of texts that items have, and the windows of items.

    First: doc_id, text_key, s (place of the first word), t, window.  Second: window, item_id.
    text_key is ``xxhash64(text)``.
    """
    items = keep(item_windows(items, window), "items")
    lengths = sorted(r.t for r in items.select("t").distinct().collect())  # at most ``window`` rows
    of_items = keep(
        items.select(
            "item_id",
            F.explode(
                F.transform(
                    F.sequence(F.lit(0), F.size("words") - F.col("t")),
                    lambda s: _window(F.col("words"), s, F.col("t")),
                )
            ).alias("w"),
        )
        .select("item_id", "w.t", "w.window")
        .distinct(),
        "windows",
    )
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    if not lengths:
        none = keyed.select("doc_id", "text_key", F.lit(0).alias("s"), F.lit(0).alias("t"), F.lit("").alias("window"))
        return none.where(F.lit(False)), of_items.select("window", "item_id")
    prints = keep(
        fingerprints(items.withColumnRenamed("t", "own"), lengths, "item_id", "own")
        .where("t = own")
        .select("t", "print")
        .distinct(),
        "prints",
    )
    doc_words = keyed.select("doc_id", "text_key", words_of(F.col("text")).alias("words"))
    places = keep(
        fingerprints(doc_words, lengths, "doc_id", "text_key")
        .join(prints, ["t", "print"], "left_semi")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("t", "place")).alias("places")),
        "places",
    )
    own = places.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "places")
    same = F.col("_doc").eqNullSafe(F.col("doc_id")) & F.col("_key").eqNullSafe(F.col("text_key"))
    windows = (
        keyed.join(own, same)
        .select("doc_id", "text_key", "places", words_of(F.col("text")).alias("words"))
        .select("doc_id", "text_key", "words", _starts(lengths, F.size("words")).alias("starts"))
        .select(
            "doc_id",
            "text_key",
            F.explode(
                F.transform("starts", lambda x: _window(F.col("words"), x["s"], x["t"]))
            ).alias("w"),
        )
        .select("doc_id", "text_key", "w.s", "w.t", "w.window")
    )
    hits = windows.join(of_items.select("t", "window").distinct(), ["t", "window"], "left_semi")
    return hits.select("doc_id", "text_key", "s", "t", "window"), of_items.select("window", "item_id")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, text_key, n_hit, item_ids (sorted as strings) of each text that holds a window."""
    hits, of_items = window_hits(docs, items, window)
    hits = keep(hits, "hits")
    covered = F.array_distinct(
        F.flatten(
            F.transform(
                F.collect_set(F.struct("s", "t")),
                lambda x: F.sequence(x["s"], x["s"] + x["t"] - 1),
            )
        )
    )
    words = hits.groupBy("doc_id", "text_key").agg(F.size(covered).cast("long").alias("n_hit"))
    found = (
        hits.select("doc_id", "text_key", "window")
        .distinct()
        .join(of_items, "window")
        .select("doc_id", "text_key", F.col("item_id").cast("string").alias("item_id"))
        .groupBy("doc_id", "text_key")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    )
    same = F.col("w.doc_id").eqNullSafe(F.col("f.doc_id")) & F.col("w.text_key").eqNullSafe(F.col("f.text_key"))
    return words.alias("w").join(found.alias("f"), same).select("w.doc_id", "w.text_key", "n_hit", "item_ids")


def marked(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The documents with the columns n_hit and item_ids; null if no window occurs.

    Columns of the documents with these names, in any case, are replaced.
    """
    found = keep(contamination(docs, items, window), "contaminated")
    same = F.col("f.doc_id").eqNullSafe(F.col("d.doc_id")) & F.col("f.text_key").eqNullSafe(F.xxhash64("d.text"))
    own = [F.col(f"d.`{c}`") for c in docs.columns if c.lower() not in ("n_hit", "item_ids")]
    return docs.alias("d").join(found.alias("f"), same, "left").select(*own, "f.n_hit", "f.item_ids")


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The documents that hold no window of any item, with all their columns."""
    found = keep(contamination(docs, items, window).select("doc_id", "text_key"), "contaminated")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & F.xxhash64("d.text").eqNullSafe(F.col("f.text_key"))
    return docs.alias("d").join(found.alias("f"), same, "left_anti")

"""One query for each operator of this subpackage, over its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from accordance.llm import op1_mixing as op1
from accordance.llm import op2_nbsvm as op2
from accordance.llm import op3_cross_entropy as op3
from accordance.llm import op4_url_reputation as op4
from accordance.llm import op5_winnowing as op5
from accordance.llm import op6_weak_toxicity as op6
from accordance.llm import op7_arc as op7
from accordance.llm import op8_token_file as op8
from accordance.llm import op9_lsh_forest as op9
from accordance.llm import op10_pivots as op10
from accordance.llm import op11_hard_negatives as op11
from accordance.llm import op12_alignment as op12
from accordance.llm import op13_suffix_dedup as op13
from accordance.llm.tables import table, words_of

#: The tokenizer file of this environment, and the id that ends a document.
TOKENIZER, END_ID = public_tokenizers.path("word_bpe_49k.json"), 1
#: The tokenizer files that are aligned.
BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

#: The rules of the URL query.
URL_RULES = {
    "net/": op4.BLOCK,
    "example.net/en/": op4.ALLOW,
    "example.com/de/": op4.BLOCK,
    "org/fr/": op4.ALLOW,
}


def op1_temperature_mixing(spark, sf_dir):
    """Sources at weights at which none passes more than one and a half times."""
    return op1.mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), max_passes=1.5).select(
        "row.doc_id",
        "row.source",
        F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_epoch").alias("epoch"),
        F.col("mix_place").alias("place"),
    )


def op2_nbsvm_quality(spark, sf_dir):
    return op2.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_cross_entropy(spark, sf_dir):
    """The target are the documents that a label calls good.

    Labels grow with the documents, so the two are merged at every size.
    """
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id", F.lit(True).alias("is_target")).distinct()
    marked = docs.select("doc_id", "text").join(good.hint("merge"), "doc_id", "left")
    return op3.cross_entropy_difference(docs, is_target=marked)


def op4_url_reputation(spark, sf_dir):
    """A page is bad if its label says toxic or of low quality."""
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(
        F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad")
    )
    return op4.filter_urls(table(spark, sf_dir, "pages"), outcomes, URL_RULES)


def op5_winnowing(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = op5.marked(docs.select("doc_id", "text"), items)
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    item_ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return found.select(
        "doc_id",
        F.size(words_of(F.col("text"))).cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(item_ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(item_ids, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op6_weak_toxicity(spark, sf_dir):
    return op6.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_arc_to_warc(spark, sf_dir):
    return op7.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_token_file(spark, sf_dir):
    return op8.tokenized(table(spark, sf_dir, "documents"), op8.word_ids(TOKENIZER, END_ID))


def op9_lsh_forest(spark, sf_dir):
    return op9.similar_classes(table(spark, sf_dir, "documents")).drop("text_key", "class_node")


def op10_pivot_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return op10.top_k(vectors, F.col("vec_id") % 50 == 0)


def op11_hard_negatives(spark, sf_dir):
    """Every seventh row has another label, so that labels and vectors disagree."""
    other = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"
    return op11.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, other)


def op12_tokenizer_alignment(spark, sf_dir):
    return op12.aligned(table(spark, sf_dir, "documents"), BYTE_LEVEL, PIECES)


def op13_suffix_dedup(spark, sf_dir):
    return op13.without_repeats(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_temperature_mixing,
        op2_nbsvm_quality,
        op3_cross_entropy,
        op4_url_reputation,
        op5_winnowing,
        op6_weak_toxicity,
        op7_arc_to_warc,
        op8_token_file,
        op9_lsh_forest,
        op10_pivot_topk,
        op11_hard_negatives,
        op12_tokenizer_alignment,
        op13_suffix_dedup,
    )
}

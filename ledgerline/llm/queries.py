"""Registered queries of the training-data operators: ``opN_<name>``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, covertree, decontaminate, hardneg, langid, lexical, licenses, linededup, minhash, oracles, packing, quality, substring, warc
from .common import table
from .sampling import bucket_of

Query = Callable[[SparkSession, str], DataFrame]


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, h: acc + h["end"] - h["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.size("near_item_ids").cast("long").alias("n_near_items"),
    )


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = warc.derivatives(warc.responses_of_pages(table(spark, sf_dir, "pages")))
    source = lambda name: F.col("source_headers")[name]
    return made.select(
        "record_id",
        "warc_type",
        "refers_to",
        "target_uri",
        "date",
        "content_type",
        "content_length",
        "block_digest",
        source("WARC-Block-Digest").alias("source_block_digest"),
        source("WARC-Payload-Digest").alias("source_payload_digest"),
        F.decode("block", "utf-8").alias("block"),
    )


def _scaled(embedding: str) -> Column:
    """Each component x as floor(256 x); from 2^52 on, doubles are whole."""
    whole = lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)
    return F.transform(embedding, lambda v: whole(F.lit(256.0) * v.cast("double")))


def op2_cover_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(covertree.usable(F.col("embedding")))
    vectors = rows.select(F.col("vec_id").alias("id"), _scaled("embedding").alias("vector"))
    found = covertree.top_k(vectors, vectors.where("id % 50 = 0"), k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit(r"\### Assistant: </turn> ok")
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    back = chat.read_back(chat.windows(turns.unionByName(added)))
    own = ~F.col("repeated")
    ordered = lambda value: F.array_sort(F.collect_list(F.when(own, F.struct("place", value.alias("value")))))
    text = lambda rows: F.array_join(F.transform(rows, lambda r: r["value"]), "")
    gathered = back.groupBy("conv_id").agg(
        F.sum(own.cast("long")).alias("n_turns"),
        ordered(F.concat("role", F.lit("\n"), "text", F.lit("\n"))).alias("turns"),
        ordered(F.coalesce("loss_text", F.lit(""))).alias("loss"),
        F.sum("window_chars").alias("formatted_chars"),
    )
    loss = text("loss")
    return gathered.select(
        "conv_id",
        "n_turns",
        F.sha2(text("turns"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path
    return packing.pack(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), ranks_path=path("byte_bpe_50k.tiktoken"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = bucket_of(F.col("doc_id"), 4) == 2
    model = langid.fit(docs, ~held_out)
    found = langid.identify(docs, model, ["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = bucket_of(F.col("doc_id"), 3) == 1
    net = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = quality.score(docs, net)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["phrase"])
    starts = F.transform(base, lambda s: s["start"].cast("long"))
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_notices"),
    )


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(F.col("label").isNotNull() & covertree.usable(F.col("embedding")))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = rows.select(F.col("vec_id").alias("id"), label.alias("label"), _scaled("embedding").alias("vector"))
    return hardneg.hard_negatives(vectors, F.col("id") % 100 == 0, positives=5, negatives=10, low=30, high=90)


QUERIES: dict[str, Query] = {
    "op1_warc_derivatives": op1_warc_derivatives,
    "op2_cover_tree_top_k": op2_cover_tree_top_k,
    "op3_chat_windows": op3_chat_windows,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_language_id": op6_language_id,
    "op7_decontaminate": op7_decontaminate,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality": op9_quality,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_license_scan": op11_license_scan,
    "op12_ranked_search": op12_ranked_search,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {**oracles.SQL, "op8_line_dedup": linededup.ORACLE_SQL, "op11_license_scan": licenses.ORACLE_SQL}
#: what SQL cannot say: a vocabulary file's ids, markup, trained models
NO_ORACLE = sorted(set(QUERIES) - set(ORACLE_SQL))

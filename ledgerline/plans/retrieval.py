"""Grounded question answering over documents made from Gold rows (UC3:
R1–R8, J6, J7, A16, A17, L2, L3, U3).

The reference pulls up to 1,000 products and vendors to the driver and
searches them in-process. Here the documents stay a DataFrame over the whole
dimension tables, the questions are a DataFrame too (one job answers all of
them), and search is the distributed exact kNN operator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import EmbedModel, embed
from ..operators.knn import MAX_BROADCAST_QUERIES, exact_knn

# Document templates, demo questions, retrieval depth, routing
# keywords and the empty-answer text.
PRODUCT_DOC = "Product %s belongs to category %s. This product is %s."
VENDOR_DOC = "Vendor %s. Their return rate is %s."
UNKNOWN = "unknown"
SLOW, FAST = "slow-moving", "fast-moving"
QUESTIONS = (
    "Which products are slow-moving?",
    "Which vendors have high return rate?",
    "List slow-moving products",
    "Which vendors perform poorly?",
    "What products are fast-moving?",
)
TOP_K = 5
CONTEXT_K = 3
NO_ANSWER = "Answer not available in data."
RATE_TEXT_TYPE = "decimal(20,6)"


def _or_unknown(c):
    return F.coalesce(c.cast("string"), F.lit(UNKNOWN))


def product_documents(dim_product: DataFrame, slow_moving: DataFrame) -> DataFrame:
    """Product rows → text; slow flag from an existence join on the distinct
    slow product ids (J7, A16, R1)."""
    slow_ids = slow_moving.select("product_id").distinct().withColumn("is_slow_moving", F.lit(True))
    p = dim_product.join(slow_ids, "product_id", "left").fillna({"is_slow_moving": False})
    text = F.format_string(
        PRODUCT_DOC,
        _or_unknown(F.col("product_name")),
        _or_unknown(F.col("categories")),
        F.when(F.col("is_slow_moving"), F.lit(SLOW)).otherwise(F.lit(FAST)),
    )
    return p.select(F.concat(F.lit("product:"), F.col("product_id")).alias("doc_id"), F.lit("product").alias("kind"), text.alias("text"))


def vendor_documents(dim_vendor: DataFrame, vendor_performance: DataFrame) -> DataFrame:
    """Vendor rows ⟕ return rate → text."""
    v = dim_vendor.join(vendor_performance.select("vendor_id", "return_rate"), "vendor_id", "left")
    rate = F.col("return_rate").cast(RATE_TEXT_TYPE)
    text = F.format_string(VENDOR_DOC, _or_unknown(F.col("vendor_name")), _or_unknown(rate))
    return v.select(F.concat(F.lit("vendor:"), F.col("vendor_id")).alias("doc_id"), F.lit("vendor").alias("kind"), text.alias("text"))


def rag_documents(products: DataFrame, vendors: DataFrame) -> DataFrame:
    """The searchable corpus."""
    return products.unionByName(vendors)


def questions_frame(spark: SparkSession, questions: Sequence[str] = QUESTIONS) -> DataFrame:
    """A question batch as a DataFrame."""
    return spark.createDataFrame([(i + 1, q) for i, q in enumerate(questions)], "question_id int, question string")


def top_k(documents: DataFrame, questions: DataFrame, k: int = TOP_K, model: EmbedModel | None = None) -> DataFrame:
    """Embed both sides with the same model and keep the k nearest documents
    per question by cosine ranking (R2–R4)."""
    docs = embed(documents, "text", "embedding", model)
    qs = embed(questions, "question", "embedding", model)
    hits = exact_knn(
        docs, qs, k, corpus_id="doc_id", corpus_vec="embedding", query_id="question_id", query_vec="embedding", normalize=True
    )
    return hits.select("question_id", "doc_id", "rank", "distance")


def questions_bounded(questions: DataFrame, bound: int = MAX_BROADCAST_QUERIES) -> bool:
    """True when the question set has at most ``bound`` rows (fetches at most
    bound + 1 ids to decide)."""
    return questions.select(F.lit(1)).limit(bound + 1).count() <= bound


def context(hits: DataFrame, documents: DataFrame, keep: int = CONTEXT_K, broadcast_hits: bool = False) -> DataFrame:
    """Hits → text, duplicates collapsed to their best rank, first ``keep``
    distinct texts (R5, A17, L3).

    ``broadcast_hits`` only when the question set is size-checked
    (``questions_bounded``): then the hits are at most k rows per question
    and are broadcast instead of shuffling the corpus by doc_id; otherwise AQE
    picks the join from measured sizes."""
    h = F.broadcast(hits) if broadcast_hits else hits
    texts = documents.select("doc_id", "text").join(h, "doc_id")
    best = texts.groupBy("question_id", "text").agg(F.min("rank").alias("hit_rank"))
    w = Window.partitionBy("question_id").orderBy("hit_rank")
    return best.withColumn("context_rank", F.row_number().over(w)).filter(F.col("context_rank") <= keep).select(
        "question_id", "context_rank", "text"
    )


def answer(questions: DataFrame, ctx: DataFrame) -> DataFrame:
    """Keyword-routed grounded answer (R6): a question mentioning slow-moving
    (else fast-moving) keeps only context that says so; other questions keep
    all context. Nothing left → the fixed no-answer text. ``retrieved_docs``
    is the JSON list of the context texts in rank order."""
    q = questions.select("question_id", "question")
    lq = F.lower(F.col("question"))
    route = F.when(lq.contains(SLOW), F.lit(SLOW)).when(lq.contains(FAST), F.lit(FAST))
    joined = ctx.join(q.withColumn("route", route), "question_id")
    kept = F.when(F.col("route").isNull() | F.lower(F.col("text")).contains(F.col("route")), F.struct("context_rank", "text"))
    per_q = joined.groupBy("question_id").agg(
        F.array_sort(F.collect_list(F.struct("context_rank", "text"))).alias("_all"),
        F.array_sort(F.collect_list(kept)).alias("_kept"),
    )
    out = q.join(per_q, "question_id", "left")
    text = F.array_join(F.transform(F.col("_kept"), lambda s: s["text"]), "\n")
    ans = F.when(F.length(F.trim(F.coalesce(text, F.lit("")))) > 0, text).otherwise(F.lit(NO_ANSWER))
    docs = F.to_json(F.coalesce(F.transform(F.col("_all"), lambda s: s["text"]), F.array().cast("array<string>")))
    return out.select("question_id", "question", ans.alias("answer"), docs.alias("retrieved_docs"))


def query_log(answers: DataFrame) -> DataFrame:
    """Rows for ``rag_query_history`` (R7): append them with ``append_table``."""
    return answers.select("question", "answer", "retrieved_docs", F.current_timestamp().alias("timestamp"))


def label_centroids(vectors: DataFrame, label: str = "label", vec: str = "embedding") -> DataFrame:
    """Mean vector per label, aggregated component-wise (partial + final, so a
    label holding most rows is combined map-side)."""
    comps = vectors.select(label, F.posexplode(vec).alias("pos", "value"))
    means = comps.groupBy(label, "pos").agg(F.avg(F.col("value").cast("double")).alias("mean"))
    return means.groupBy(label).agg(F.array_sort(F.collect_list(F.struct("pos", "mean"))).alias("_c")).select(
        label, F.transform("_c", lambda s: s["mean"]).alias("centroid")
    )

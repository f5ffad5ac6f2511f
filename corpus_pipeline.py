"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its output is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``. A row is known by (doc_id, hash of its text),
so rows without an id, or that repeat one, are judged on their own; rows that are
alike in both become one in the near-duplicate stage. NULL and wordless texts go
in the first stage; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, langid, linededup, minhash, packing
from ledgerline.llm.common import staged, table


def _row(docs: DataFrame) -> Column:
    """A whole row as one column ``row``: its names meet none of those an operator works with or adds."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def _unpacked(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of ``row``, some of them changed."""
    return rows.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in columns])


def _named(docs: DataFrame) -> DataFrame:
    """(doc_id, text), where doc_id is the row's ident."""
    return docs.select(F.struct("doc_id", F.xxhash64("text").alias("row")).alias("doc_id"), "text")


def _matching(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Packed docs whose ident is (left_semi) or is not (left_anti) among those found."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("hash"), _row(docs))
    ids = found.select(F.col("doc_id.doc_id").alias("id"), F.col("doc_id.row").alias("known")).distinct()
    return rows.join(ids, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("known")), how)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not recognized go; a missing ``lang`` is filled in."""
    found = langid.identify(docs.select("text", _row(docs)), langid.fit(docs), ["row"]).where(~F.col("lang_rejected"))
    return _unpacked(found, docs.columns, lang=F.coalesce("row.lang", "lang_pred"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of repeated three-line windows go; a document left without text goes too."""
    cut = linededup.line_dedup(docs.select("doc_id", "text", _row(docs))).where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))
    return _unpacked(cut, docs.columns, **changed)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 80 %) stays."""
    found = minhash.near_duplicates(_named(docs), shingle=5, percent=80)
    return _unpacked(_matching(docs, found.where("kept"), "left_semi").dropDuplicates(["doc_id", "hash"]), docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontaminate.decontaminate(_named(docs), table(spark, sf_dir, "benchmark"))
    return _unpacked(_matching(docs, found.where(F.size("hits") > 0), "left_anti"), docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their place in a training sequence."""
    import public_tokenizers

    path = public_tokenizers.path
    return packing.pack(docs, path("byte_bpe_50k.json"), ranks_path=path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

# packing by a BPE vocabulary and a trained classifier cannot be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

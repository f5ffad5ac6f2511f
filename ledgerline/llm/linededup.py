"""Line dedup over overlapping windows of three consecutive lines.

Lines are the text between line feeds, compared exactly. Every run of
``window`` lines of a document is hashed (128 bits). A window occurs first in
the row with the smallest (doc_id, text hash), at its smallest line; every later
occurrence, in another document or further on in the same one, covers its lines,
and covered lines are removed once, however many windows cover them.

Shuffles: (hash, place) rows, aggregated map-side to the first place of each
hash; the repeated hashes are staged and joined back (a hash that a third of all
rows share is split by the skew join); then the start lines of one document meet
its text.

Defined cases: NULL text stays NULL with no lines; a text of fewer than
``window`` lines is left as it is; an empty text is one empty line; rows that
repeat a doc_id with the same text count as one document and stay alike, with
another text they are judged apart; a NULL doc_id sorts first; extra columns of
any name pass through, but for one named like a result (n_lines, n_removed), which is
replaced; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

WINDOW = 3


def _windows(docs: DataFrame, window: int) -> DataFrame:
    lines = F.split("text", "\n", -1)
    starts = F.sequence(F.lit(0), F.size("__lines") - window)
    part = lambda i: [F.col("__lines")[i + j] for j in range(window)]
    return (
        docs.where(F.col("text").isNotNull())
        .select("doc_id", F.xxhash64("text").alias("__row"), lines.alias("__lines"))
        .where(F.size("__lines") >= window)
        .select("doc_id", "__row", F.explode(F.transform(starts, lambda i: F.struct(i.alias("at"), F.xxhash64(*part(i)).alias("h1"), F.xxhash64(F.lit(window), *part(i)).alias("h2")))).alias("w"))
        .select("doc_id", "__row", "w.at", "w.h1", "w.h2")
    )


def line_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``text`` reduced to its kept lines, n_lines and n_removed."""
    extra = [c for c in docs.columns if c not in ("doc_id", "text", "n_lines", "n_removed")]
    # they travel as one column, so that their names meet no working name
    packed = F.struct(*[F.col(f"`{c}`") for c in extra]) if extra else F.lit(0)
    docs = docs.select("doc_id", "text", packed.alias("__extra"))
    spots = _windows(docs, window)
    spot = F.struct("doc_id", "__row", "at")
    firsts = spots.groupBy("h1", "h2").agg(F.min(spot).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2", "first")
    firsts = staged(firsts, "repeated-windows")
    later = spots.join(firsts, ["h1", "h2"]).where(spot > F.col("first"))
    covered = later.groupBy("doc_id", "__row").agg(F.collect_set("at").alias("__at")).withColumnRenamed("doc_id", "__doc").withColumnRenamed("__row", "__key")
    rows = docs.withColumn("__row", F.xxhash64("text"))
    joined = rows.join(covered, (F.col("doc_id").eqNullSafe(F.col("__doc"))) & (F.col("__row") == F.col("__key")), "left")
    lines = F.split("text", "\n", -1)
    gone = F.flatten(F.transform("__at", lambda s: F.sequence(s, s + window - 1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    changed = F.col("__at").isNotNull()
    return joined.select(
        "doc_id",
        *[F.col("__extra")[c].alias(c) for c in extra],
        F.when(changed, F.array_join(F.transform(kept, lambda i: lines[i]), "\n")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(changed, F.size(lines) - F.size(kept)).otherwise(0).cast("long").alias("n_removed"),
    )


ORACLE_SQL = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS a FROM documents),
w AS (SELECT doc_id, a, unnest(range(1, len(a) - 1)) AS p FROM d WHERE len(a) >= 3),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY a[p:p + 2] ORDER BY doc_id, p) AS occurrence FROM w),
c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 3)) AS q FROM r WHERE occurrence > 1),
g AS (SELECT doc_id, list(q) AS qs, count(*) AS n FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(a), 0)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_removed,
  CASE WHEN n IS NULL THEN text ELSE array_to_string(list_filter(a, lambda v, i: NOT list_contains(qs, i)), chr(10)) END AS text
FROM d LEFT JOIN g USING (doc_id)
"""

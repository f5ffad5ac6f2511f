"""License scan by diagonal voting, in DataFrame functions only.

Templates (short phrases and license notices) and texts are cut into words, and
both into all their rolling word k-grams. Every gram hash of a text is joined with
the template positions of that hash (the templates are a parameter of checked
size, so their side is broadcast); the words behind each hit are compared, so a
hash collision gives no vote. A hit at word p of the text and word q of the
template votes for the diagonal p - q. Votes are summed per diagonal, neighbouring
diagonals are merged (words were put in or left out of the notice), and a span
is kept if it verifies: a phrase needs every gram on one diagonal, a notice a
share ``COVERAGE`` of its grams within twice its length.

A text is read once and its words are never shuffled: only hits are. Each text also
holds the empty gram, which the empty template meets, so a text without any
license word still gives its row through the same join.

Words: A-Z is lowered, then maximal runs of ``0-9a-z`` and of characters beyond
ASCII. Defined cases: a NULL or empty text has no words and no spans; rows that
repeat an id, with or without the same text, or lack one, each give a row; extra
columns are ignored; no rows give none.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 4  # words of a gram; templates of fewer than 2 K words use SHORT
SHORT = 2
MAX_DRIFT = 8  # diagonals farther apart are another place
COVERAGE = 0.6
MAX_TEMPLATE_GRAMS = 200_000

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    name: str
    label: str
    text: str
    phrase: bool = False  # matches as a whole only


# The base phrases, and published license notices with their labels.
TEMPLATES = (
    Template("mit phrase", "mit", "mit license", phrase=True),
    Template("apache phrase", "apache", "apache license", phrase=True),
    Template("gpl phrase", "gpl", "general public license", phrase=True),
    Template(
        "mit notice",
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions",
    ),
    Template("apache line", "apache", "Licensed under the Apache License, Version 2.0"),
    Template(
        "apache notice",
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    Template("gpl line", "gpl", "This work is licensed under the GNU General Public License, version 3"),
    Template(
        "gpl notice",
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    Template(
        "lgpl notice",
        "lgpl",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
        "Free Software Foundation",
    ),
    Template(
        "bsd notice",
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    Template(
        "isc notice",
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ),
    Template(
        "mpl notice",
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
    Template("cc by nc line", "cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc by notice", "cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template(
        "unlicense notice",
        "unlicense",
        "This is free and unencumbered software released into the public domain",
    ),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def lowered(words: Column) -> Column:
    """A-Z lowered; other characters stay (``lower`` would also change those beyond ASCII)."""
    return F.transform(words, lambda w: F.when(F.octet_length(w) == F.char_length(w), F.lower(w)).otherwise(F.translate(w, UPPER, LOWER)))


def gram_hashes(words: Column, size: int) -> Column:
    """Hash of the ``size`` words from each position on; none if there are fewer."""
    at = F.sequence(F.lit(1), F.size(words) - F.lit(size - 1))
    return F.when(F.size(words) >= size, F.transform(at, lambda i: F.xxhash64(F.slice(words, i, size)))).otherwise(F.array().cast("array<bigint>"))


def gram_size(n_words: int) -> int:
    return K if n_words >= 2 * K else min(SHORT, n_words)


def _plain_words(text: str) -> list[str]:
    """The same words on the driver, to size a template."""
    import re

    return [w.translate(str.maketrans(UPPER, LOWER)) for w in re.split(SEPARATORS, text) if w]


class _Facts:
    """Template facts by index, as literal lookups; index -1 is the empty template."""

    def __init__(self, templates: Sequence[Template]):
        self.templates = list(templates)
        words = [_plain_words(t.text) for t in templates]
        if not all(words):
            raise ValueError("a template needs at least one word")
        self.n_words = [len(w) for w in words]
        self.sizes = [gram_size(n) for n in self.n_words]
        self.n_grams = [n - s + 1 for n, s in zip(self.n_words, self.sizes, strict=True)]
        if sum(self.n_grams) > MAX_TEMPLATE_GRAMS:
            raise ValueError(f"templates of more than {MAX_TEMPLATE_GRAMS} grams in all")
        self.drift = [0 if t.phrase else min(MAX_DRIFT, n // 4) for t, n in zip(templates, self.n_words, strict=True)]

    def look(self, values: list, empty) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in [empty, *values]]), F.col("template") + 2)

    def positions(self, spark: SparkSession) -> DataFrame:
        """(hash, template, at, size, gram) of every gram of every template, and of the empty one."""
        listed = [F.struct(F.lit(-1).alias("template"), F.lit("").alias("text"), F.lit(0).alias("size"))]
        listed += [F.struct(F.lit(i).alias("template"), F.lit(t.text).alias("text"), F.lit(s).alias("size")) for i, (t, s) in enumerate(zip(self.templates, self.sizes, strict=True))]
        rows = spark.range(1).select(F.explode(F.array(*listed)).alias("t")).select("t.template", "t.size", lowered(words_of(F.col("t.text"))).alias("words"))
        last = F.when(F.col("template") < 0, 0).otherwise(F.size("words") - F.col("size"))
        cut = rows.select("template", "size", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
        gram = F.slice("words", F.col("at") + 1, F.col("size"))
        return cut.select(F.xxhash64(gram).alias("hash"), "template", "at", "size", gram.alias("gram"))


def license_spans(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, doc_id: str = "doc_id", text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, and ``spans``, an array of
    (start, end, template, label, phrase, coverage) in words from 0, ordered."""
    facts = _Facts(templates)
    sizes = sorted(set(facts.sizes))
    rows = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("row"), words_of(F.col(text)).alias("words"))
    rows = rows.select("doc", "row", F.size("words").alias("n"), lowered(F.col("words")).alias("words"))
    # one array of gram hashes per text: the empty gram, then those of each size
    empty = F.array(F.xxhash64(F.array().cast("array<string>")))
    grams = rows.select("doc", "row", "n", "words", F.concat(empty, *[gram_hashes(F.col("words"), s) for s in sizes]).alias("grams"))
    # outer, though no array is empty: for a plain explode Catalyst infers a filter on its size and works out all grams in it once more
    dealt = grams.select("doc", "row", "n", "words", F.posexplode_outer("grams").alias("place", "hash"))
    before, at = F.lit(1), F.lit(0)
    for s in sizes:
        at = F.when(F.col("size") == s, F.col("place") - before).otherwise(at)
        before = before + F.greatest(F.col("n") - F.lit(s - 1), F.lit(0))
    hits = dealt.join(F.broadcast(facts.positions(docs.sparkSession)), "hash").withColumn("p", at)
    hits = hits.where(F.slice("words", F.col("p") + 1, F.col("size")) == F.col("gram"))
    diagonals = hits.groupBy("doc", "row", "n", "template", (F.col("p") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("votes"),  # a set, so rows alike in id and text don't vote twice
        F.min("p").alias("start"),
        F.max(F.col("p") + F.col("size")).alias("end"),
        F.count_if(F.col("template") < 0).alias("rows"),
    )
    order = Window.partitionBy("doc", "row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > facts.look(facts.drift, 0)
    island = F.sum(F.coalesce(apart, F.lit(False)).cast("int")).over(order)
    merged = diagonals.withColumn("island", island).groupBy("doc", "row", "n", "template", "island").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("votes")))).alias("votes"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.max("rows").alias("rows"),
    )
    share = F.col("votes") / facts.look(facts.n_grams, 1)
    phrase = facts.look([t.phrase for t in facts.templates], False)
    fits = (share >= F.when(phrase, 1.0).otherwise(coverage)) & (F.col("end") - F.col("start") <= 2 * facts.look(facts.n_words, 0))
    span = F.struct(
        "start",
        "end",
        facts.look([t.name for t in facts.templates], "").alias("template"),
        facts.look([t.label for t in facts.templates], "").alias("label"),
        phrase.alias("phrase"),
        share.alias("coverage"),
    )
    found = merged.groupBy("doc", "row", "n").agg(F.array_sort(F.collect_list(F.when((F.col("template") >= 0) & fits, span))).alias("spans"), F.max("rows").cast("int").alias("rows"))
    found = found.select("doc", "n", "spans", F.explode(F.array_repeat(F.lit(0), F.col("rows"))).alias("each"))
    return found.select(F.col("doc").alias(doc_id), F.col("n").cast("long").alias("n_words"), "spans")


def _oracle() -> str:
    """The same spans in DuckDB: grams as text, joined with the templates' grams."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    listed = []
    for i, t in enumerate(TEMPLATES):
        words = _plain_words(t.text)
        size = gram_size(len(words))
        drift = 0 if t.phrase else min(MAX_DRIFT, len(words) // 4)
        listed += [f"({i}, {quoted(t.label)}, {t.phrase}, {size}, {len(words)}, {drift}, {j}, {quoted(' '.join(words[j : j + size]))})" for j in range(len(words) - size + 1)]
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return f"""
WITH positions(template, label, phrase, size, n_template, drift, spot, gram) AS (VALUES {", ".join(listed)}),
counted AS (SELECT *, count(*) OVER (PARTITION BY template) AS n_grams FROM positions),
d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all({lower}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words FROM documents),
grams AS (
  SELECT rid, size, p, array_to_string(words[p + 1 : p + size], ' ') AS gram
  FROM d, (VALUES ({SHORT}), ({K})) s(size), unnest(range(len(words) - size + 1)) u(p)
),
diagonals AS (
  SELECT rid, template, label, phrase, n_template, n_grams, drift, p - spot AS diagonal, list(spot) AS votes, min(p) AS first, max(p + size) AS last
  FROM grams JOIN counted USING (size, gram) GROUP BY ALL
),
marked AS (
  SELECT *, coalesce(diagonal - lag(diagonal) OVER w > drift, false)::INT AS apart FROM diagonals WINDOW w AS (PARTITION BY rid, template ORDER BY diagonal)
),
islands AS (SELECT *, sum(apart) OVER (PARTITION BY rid, template ORDER BY diagonal) AS island FROM marked),
spans AS (
  SELECT rid, label, phrase, n_template, min(first) AS first, max(last) AS last, len(list_distinct(flatten(list(votes)))) / n_grams AS share
  FROM islands GROUP BY rid, template, label, phrase, n_template, n_grams, island
),
kept AS (SELECT * FROM spans WHERE share >= CASE WHEN phrase THEN 1.0 ELSE {COVERAGE} END AND last - first <= 2 * n_template)
SELECT doc_id, CAST(len(any_value(words)) AS BIGINT) AS n_words, count(*) FILTER (WHERE phrase) AS n_base,
  CAST(min(first) FILTER (WHERE phrase) AS BIGINT) AS first_word, CAST(max(first) FILTER (WHERE phrase) AS BIGINT) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE label IS NOT NULL), '') AS labels,
  coalesce(max(share), 0.0) AS score, count(*) FILTER (WHERE NOT phrase) AS n_notices
FROM d LEFT JOIN kept USING (rid) GROUP BY rid, doc_id
"""


ORACLE_SQL = _oracle()

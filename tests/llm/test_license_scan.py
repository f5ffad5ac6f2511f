"""License scan: base places against a plain search, notices with changes, and defined cases."""

import random
import re

import pytest

from ledgerline.llm import licenses
from ledgerline.llm.queries import QUERIES

PHRASES = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
MIT = next(t.text for t in licenses.TEMPLATES if t.name == "mit notice")
EXTRA = "doc_id long, text string, words string, grams int, hash long, template int, rows int, n long, spans string, place int"


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_base(text):
    words = plain_words(text)
    found = [(i, label) for label, p in PHRASES.items() for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in found}))


def table(spark, rows, tmp_path):
    spark.createDataFrame([(i, t, "w", 1, 2, 3, 4, 5, "s", 6) for i, t in rows], EXTRA).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def base_rows(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in df.collect()), key=str)


def test_base_places_equal_a_plain_search(spark, tmp_path):
    rng = random.Random(3)
    vocabulary = ["MIT", "License", "apache", "general", "public", "GENERAL", "x", "été", "l'", "mİt", "2", "ЖЖ", "K"]
    rows = [(i, "".join(rng.choice(vocabulary) + rng.choice([" ", "-", "\n", "  ", ". ", "_"]) for _ in range(rng.randrange(60)))) for i in range(200)]
    rows += [(300, None), (301, ""), (302, " .,"), (303, "mit"), (304, "MIT license"), (None, "mit license"), (None, None), (304, "MIT license"), (304, "other"), (305, "mit license " * 3000)]
    found = QUERIES["op11_license_scan"](spark, table(spark, rows, tmp_path))
    assert base_rows(found) == sorted(((i, *plain_base(t)) for i, t in rows), key=str)
    for r in found.collect():
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))


def test_notices_with_words_put_in_and_left_out(spark):
    words = MIT.split()
    changed = [*words[:20], "and", "also", *words[20:45], *words[47:]]
    texts = {1: MIT, 2: " ".join(changed), 3: " ".join(words[:12]), 4: "intro " + MIT.upper() + " and again " + MIT, 5: "of the software and to the use of this file in the license"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in licenses.license_spans(docs).collect()}
    assert [s["label"] for s in spans[1]] == ["mit"] and spans[1][0]["coverage"] == 1.0
    assert [(s["label"], s["start"], s["end"]) for s in spans[2]] == [("mit", 0, len(plain_words(texts[2])))] and 0.7 < spans[2][0]["coverage"] < 1
    assert spans[3] == [] and spans[5] == []  # a part of a notice is none
    assert [s["start"] for s in spans[4]] == [1, 1 + len(plain_words(MIT)) + 2]


def test_templates_are_a_parameter_and_checked(spark):
    docs = spark.createDataFrame([(1, "a b c a b c d"), (2, "c")], "doc_id long, text string")
    own = [licenses.Template("one", "single", "c", phrase=True), licenses.Template("two", "pair", "a b c", phrase=True)]
    spans = {r["doc_id"]: [(s["template"], s["start"]) for s in r["spans"]] for r in licenses.license_spans(docs, own).collect()}
    assert spans == {1: [("two", 0), ("one", 2), ("two", 3), ("one", 5)], 2: [("one", 0)]}
    with pytest.raises(ValueError):
        licenses.license_spans(docs, [licenses.Template("none", "none", " - ")])


def test_empty_table(spark):
    assert licenses.license_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0

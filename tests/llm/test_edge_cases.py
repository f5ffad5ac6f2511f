"""Nulls, empty and very long texts, ties, repeated rows, empty tables and extra
columns: every operator and every pipeline stage has a defined result."""

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import chat, covertree, decontaminate, langid, linededup, minhash, packing, quality, substring, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, row string, sequence_id int"
WORDS = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
LINES = "\n".join(f"line {i} of a text that repeats" for i in range(5))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, WORDS, "en"),
        (2, WORDS, "en"),
        (2, WORDS, "en"),  # a repeated row
        (3, "x " + WORDS + " y", "en"),
        (3, "another text under the same id", None),
        (4, LINES, "en"),
        (5, "head\n" + LINES + "\ntail", "en"),
        (6, None, "en"),
        (7, "", None),
        (8, "  \n\t ", "fr"),
        (9, "1234 !!", "en"),
        (10, "Été à l'école", "fr"),
        (None, WORDS, "en"),
        (None, None, None),
        (11, "long " * 30000, "en"),
    ]
    return spark.createDataFrame([(i, t, lang, None, None, "n", "r", 1) for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    passage = " ".join(WORDS.split()[10:24])
    return spark.createDataFrame([(1, passage), (1, passage), (2, "Été à"), (3, None), (None, passage), (4, "")], "item_id long, text string")


def by_id(df, *cols):
    return sorted(((r["doc_id"], *[r[c] for c in cols]) for r in df.collect()), key=lambda t: (t[0] is None, str(t)))


def test_decontaminate(docs, empty, items):
    found = decontaminate.decontaminate(docs, items)
    assert found.count() == 15
    rows = by_id(found.select("doc_id", F.size("hits").alias("h"), F.array_join(F.array_sort("item_ids"), ",").alias("i"), "n_words"), "h", "i", "n_words")
    assert rows[0] == (1, 1, "1", 120) and (10, 1, "2", 4) in rows and (6, 0, "", 0) in rows
    assert by_id(found.select("doc_id", "hits.start", "hits.end"), "start", "end")[0] == (1, [10], [24])
    blocks = decontaminate.decontaminate(docs, items, max_test_words=8)  # several blocks of items, merged
    assert by_id(blocks.select("doc_id", "hits"), "hits") == by_id(found.select("doc_id", "hits"), "hits")
    assert decontaminate.decontaminate(empty, items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).where(F.size("hits") > 0).count() == 0


def test_proximity(spark, items):
    moved = WORDS.split()[10:24]
    moved[7:7] = ["between", "them"]
    near = decontaminate.decontaminate(spark.createDataFrame([(1, " ".join(moved))], "doc_id long, text string"), items).first()
    assert near["near_item_ids"] == ["1"] and near["item_ids"] == []


def test_line_dedup(docs, empty):
    rows = {(r["doc_id"], r["n_removed"]): r for r in linededup.line_dedup(docs).collect()}
    assert rows[5, 5]["text"] == "head\ntail" and rows[4, 0]["text"] == LINES
    assert rows[6, 0]["text"] is None and rows[6, 0]["n_lines"] == 0 and rows[7, 0]["n_lines"] == 1
    assert linededup.line_dedup(docs).columns[-3:] == ["text", "n_lines", "n_removed"]
    assert linededup.line_dedup(empty).count() == 0


def test_near_duplicates(docs, empty):
    rows = by_id(minhash.near_duplicates(docs), "n_shingles", "component_id", "kept")
    assert [r for r in rows if r[0] == 2] == [(2, 116, 1, False)] * 2 and (3, 118, 1, False) in rows and (6, 0, 6, True) in rows
    assert (None, 116, 1, False) in rows and (3, 2, 3, True) in rows and (7, 0, 7, True) in rows
    assert minhash.near_duplicates(docs, block=1).where("kept").count() == minhash.near_duplicates(docs).where("kept").count()
    assert minhash.near_duplicates(empty).count() == 0


def test_near_duplicates_of_rows_without_or_with_one_id(spark):
    texts = [WORDS, "x " + WORDS, WORDS + " y"]
    without = spark.createDataFrame([(7, texts[0]), (None, texts[1]), (None, texts[2]), (None, texts[2])], "doc_id long, text string")
    assert by_id(minhash.near_duplicates(without), "component_id", "kept") == [(7, 7, True)] + [(None, 7, False)] * 3
    alike = spark.createDataFrame([(5, t) for t in texts] * 3 + [(2, "z " + WORDS), (5, "something else")], "doc_id long, text string")
    assert by_id(minhash.near_duplicates(alike), "component_id", "kept") == [(2, 2, True)] + [(5, 2, False)] * 9 + [(5, 5, True)]


def test_substring(docs, empty):
    rows = by_id(substring.substring_dedup(docs), "n_words", "n_removed")
    assert (1, 120, 0) in rows and rows.count((2, 120, 120)) == 2 and (3, 122, 120) in rows and (3, 6, 0) in rows
    assert (None, 120, 0) in rows and (6, 0, 0) in rows and (11, 30000, 0) in rows and len(rows) == 15
    assert substring.substring_dedup(empty).count() == 0


def test_packing(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.pack(docs, path, keep_ids=True).collect()
    assert {r["doc_id"] for r in rows} == {r[0] for r in docs.select("doc_id").collect()}
    places: dict[int, list] = {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        assert [o for o, _ in sorted(held)] == [sum(n for _, n in sorted(held)[:i]) for i in range(len(held))]
    assert sorted((r["length"] for r in rows if r["doc_id"] == 11), reverse=True)[0] == 2048
    assert packing.pack(empty, path).count() == 0


def test_language(docs, empty):
    model = langid.fit(docs)
    rows = {(r["doc_id"], r["lang_pred"]) for r in langid.identify(docs, model).collect()}
    assert {(6, "und"), (7, "und"), (8, "und"), (9, "und"), (None, "und")} <= rows and (1, "en") in rows
    assert langid.fit(empty) is None and langid.identify(empty, model).count() == 0
    alone = langid.identify(docs, None)
    assert {r["lang_pred"] for r in alone.collect()} == {"und"} and alone.where("lang_rejected").count() == 5
    one = langid.fit(docs.where("lang = 'fr'"))
    assert langid.identify(docs.where("doc_id = 1"), one).first()["lang_pred"] == "fr"


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, None), (None, 1), (10, 7)], "doc_id long, quality int")
    net = quality.fit(docs, labels)
    scores = [r["score"] for r in quality.score(docs, net).collect()]
    assert len(scores) == 15 and all(0 <= s <= 1 for s in scores)
    assert quality.fit(docs, labels.limit(0)) == 0.5 and quality.score(empty, net).count() == 0
    assert quality.score(docs, quality.fit(docs, labels.where("quality = 1"))).first()["score"] == pytest.approx(2 / 3)


def test_cover_tree(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (50, [1.0, 2.0]), (3, [2.0, 4.0]), (3, [2.0, 4.0]), (4, [nan, 1.0]), (5, None), (6, [1.0, None]), (None, [9.0, 9.0]), (7, [1.0]), (8, [1e200, 0.0])]
    frame = spark.createDataFrame(rows, "id long, vector array<double>").where(covertree.usable(F.col("vector")))
    found = covertree.top_k(frame, frame.where("id % 50 = 0"), k=3)
    got = sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in found.collect())
    assert got[:3] == [(0, 1, 8, 2**63 - 1), (0, 2, 3, 10), (0, 3, 50, 5)] and len(got) == 6
    assert covertree.top_k(frame.limit(0), frame.limit(0)).count() == 0


def test_chat(spark):
    told = "\\### Assistant: </turn> ok <text> \\l \\b"
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", told), (1, 2, "assistant", told), (1, 2, "assistant", "again"), (1, None, None, None), (2, 0, "system", "only"), (None, 0, "user", ""), (3, 0, "assistant", "w " * 3000)]
    rows += [(9, i, "user" if i % 2 else "assistant", f"turn {i} " * 20) for i in range(600)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, window int")
    made = chat.windows(frame, budget=200, history_tokens=60)
    back = chat.read_back(made).where("NOT repeated").collect()
    own = sorted((str(r["conv_id"]), r["place"], r["role"], r["text"]) for r in back)
    want: list = []
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        want += [(str(conv), i, r[2] or "", r[3] or "") for i, r in enumerate(turns)]
    assert own == sorted(want)
    assert all((r["loss_text"] is not None) == (r["role"] == "assistant") and r["loss_text"] in (None, r["text"]) for r in back)
    assert made.where("conv_id = 9").agg(F.max("n_tokens")).first()[0] <= 200
    assert chat.windows(frame.limit(0)).count() == 0


def test_warc(spark):
    pages = spark.createDataFrame([(1, "http://a.example/", "<p>x</p>", 1), (1, "http://a.example/", "<p>x</p>", 1), (2, None, "", 1), (None, "u", None, 1)], "page_id long, url string, html string, block int")
    rows = warc.derivatives(warc.responses_of_pages(pages)).collect()
    assert sorted(r["warc_type"] for r in rows) == ["conversion"] * 3 + ["metadata"] * 4
    assert len({r["record_id"] for r in rows}) == 5 and all(r["content_length"] == len(r["block"]) for r in rows)
    head, _, body = warc.warc_bytes(rows[0].asDict()).partition(b"\r\n\r\n")
    assert b"WARC-Refers-To: <urn:uuid:" in head and body == bytes(rows[0]["block"]) + b"\r\n\r\n"
    assert warc.derivatives(warc.responses_of_pages(pages.limit(0))).count() == 0


def test_pipeline(spark, docs, empty, items, tmp_path):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame in (docs, empty):
        rows = frame
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, str(tmp_path))
            out.write.parquet(f"{tmp_path}/{name}-{frame is empty}")
            if name != "best_fit_packing":
                assert out.columns == frame.columns
            rows = spark.read.parquet(f"{tmp_path}/{name}-{frame is empty}")
        ids = {r["doc_id"] for r in rows.collect()}
        assert ids == (set() if frame is empty else {3, 4, 5, 11})

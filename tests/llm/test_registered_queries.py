"""Registered queries and the pipeline that SQL cannot express, against plain versions on the given tables."""

import hashlib
import re
import zlib
from collections import defaultdict
from html.parser import HTMLParser

import corpus_pipeline
import numpy as np
import public_tokenizers
from conftest import SF_SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import warc
from ledgerline.llm.queries import NO_ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


def collected(spark, name, sf_dir=SF_SMALL):
    return [r.asDict() for r in QUERIES[name](spark, sf_dir).collect()]


def given(spark, table, *columns, sf_dir=SF_SMALL):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns).collect()]


def test_every_query_without_sql_is_tested_here():
    assert set(NO_ORACLE) == {"op1_warc_derivatives", "op3_chat_windows", "op4_best_fit_packing", "op6_language_id", "op9_quality"}


# ---- op1 -----------------------------------------------------------------------------------------


class Visible(HTMLParser):
    hidden = {"script", "style", "noscript", "template", "textarea", "svg", "head"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.depth, self.links, self.title, self.in_title = [], 0, [], "", False

    def handle_starttag(self, tag, attrs):
        if tag in self.hidden - {"head"}:
            self.depth += 1
        if tag == "a" and dict(attrs).get("href") is not None:
            self.links.append(dict(attrs)["href"])

    def handle_endtag(self, tag):
        if tag in self.hidden - {"head"}:
            self.depth = max(0, self.depth - 1)

    def handle_data(self, data):
        if not self.depth:
            self.out.append(data)


def test_warc_records_of_every_page(spark):
    made = defaultdict(dict)
    for r in collected(spark, "op1_warc_derivatives"):
        made[r["refers_to"]][r["warc_type"]] = r
    sources = [r.asDict() for r in warc.responses_of_pages(spark.read.parquet(f"{SF_SMALL}/pages.parquet")).collect()]
    pages = dict(given(spark, "pages", "url", "html"))
    assert set(made) == {s["record_id"] for s in sources} and len(sources) == len(given(spark, "pages", "page_id"))
    for s in sources:
        own = made[s["record_id"]]
        assert set(own) == {"metadata", "conversion"}
        for r in own.values():
            assert r["target_uri"] == s["target_uri"] and r["content_length"] == len(r["block"].encode()) and r["block_digest"] == warc.digest(r["block"].encode())
            assert r["source_block_digest"] == "sha256:" + hashlib.sha256(bytes(s["block"])).hexdigest()
            assert r["source_payload_digest"] == "sha256:" + hashlib.sha256(pages[s["target_uri"]].encode()).hexdigest()
        meta, text = own["metadata"]["block"], own["conversion"]["block"]
        assert f"conversion-record: {own['conversion']['record_id']}\r\n" in meta and f"conversion-digest: {own['conversion']['block_digest']}\r\n" in meta
        plain = Visible()
        plain.feed(pages[s["target_uri"]])
        plain.close()
        assert "".join(text.split()) == "".join("".join(plain.out).split())
        assert meta.count("outlink: ") <= len(plain.links) and (not plain.links or "outlink: " in meta)


# ---- op3 -----------------------------------------------------------------------------------------


def test_chat_digests_of_every_conversation(spark):
    rows = given(spark, "conversations", "conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn, role or "", text or ""))
    got = {r["conv_id"]: r for r in collected(spark, "op3_chat_windows")}
    assert set(got) == set(turns)
    for conv, own in turns.items():
        own.sort()
        loss = "".join(t for _, role, t in own if role == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(own) and r["turns_sha256"] == hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in own).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] >= sum(len(role) + len(t) for _, role, t in own)


# ---- op4 -----------------------------------------------------------------------------------------


def check_packing(rows, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == {i for i, _ in docs}
    total = 0
    for i, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        own, at = sorted(by_doc[i], key=lambda r: r["piece"]), 0
        assert [r["piece"] for r in own] == list(range(-(-len(ids) // 2048)))
        for r in own:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and all(r["length"] == 2048 for r in own[1:])
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) <= 1.02 * -(-total // 2048) + 1


def test_packing_of_every_document(spark):
    check_packing(collected(spark, "op4_best_fit_packing"), given(spark, "documents", "doc_id", "text"))


# ---- op6, op9 ------------------------------------------------------------------------------------


def test_languages_held_out(spark):
    lang = dict(given(spark, "documents", "doc_id", "lang", sf_dir=SF))
    rows = collected(spark, "op6_language_id", SF)
    assert len(rows) == len(lang) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and lang[r["doc_id"]] and r["lang_pred"] != "und"]
    assert len(held) > 100 and sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_quality_held_out(spark):
    label = dict(given(spark, "labels", "doc_id", "quality", sf_dir=SF))
    rows = collected(spark, "op9_quality", SF)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(r["score"], label[r["doc_id"]]) for r in rows if r["held_out"] and label.get(r["doc_id"]) is not None]
    good, bad = ([s for s, q in held if q == v] for v in (1, 0))
    assert len(held) > 80 and np.mean([(s >= 0.5) == q for s, q in held]) >= 0.88
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) >= 0.93


# ---- the pipeline --------------------------------------------------------------------------------


def kept_lines(docs, window=3):
    """Plain line dedup: every window's first place by (doc_id, line)."""
    seen, covered = set(), defaultdict(set)
    for i, text in sorted((d for d in docs if d[1] is not None), key=lambda d: d[0]):
        lines = text.split("\n")
        for p in range(len(lines) - window + 1):
            key = tuple(lines[p : p + window])
            if key in seen:
                covered[i] |= set(range(p, p + window))
            seen.add(key)
    return {i: None if t is None else t if not covered[i] else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in covered[i]) for i, t in docs}


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def components(docs, percent=80):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    for a, s in sets.items():
        for b in {b for x in s for b in holders[x] if b > a}:
            both = len(s & sets[b])
            if 100 * both >= percent * (len(s) + len(sets[b]) - both):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i: find(i) for i in sets}


def windows(text, n=10):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def test_pipeline_stage_by_stage(spark):
    """Every stage on what its predecessor kept, by a plain version; then the whole pipeline. The rows carry
    columns named like those that the stages work with or return."""
    plain_docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = ["__row", "__id", "__hash", "__doc", "__key", "__at", "__lines", "n_lines", "n_removed", "lang_pred", "lang_score", "node", "row", "kept", "hits"]
    docs = plain_docs.withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in names})
    columns = docs.columns

    def run(name, now):
        out = dict(corpus_pipeline.STAGES)[name](spark, now, SF_SMALL).checkpoint()
        if name != "best_fit_packing":
            assert out.columns == columns
            assert all(r[n] == f"{n} {r['doc_id']}" for r in out.collect() for n in names)
        return out

    pairs = lambda df: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    told = run("language_id", docs)
    assert {i for i, t in pairs(docs) if t and len(t.split()) > 20} <= {i for i, _ in pairs(told)} and all(t and re.search(r"\w", t) for _, t in pairs(told))
    cut = run("line_dedup", told)
    want = kept_lines(pairs(told))
    assert dict(pairs(cut)) == {i: t for i, t in want.items() if t == dict(pairs(told))[i] or t.strip()}
    single = run("near_duplicates", cut)
    label = components(pairs(cut))
    assert sorted(i for i, _ in pairs(single)) == sorted(i for i, c in label.items() if i == c)
    clean = run("benchmark_decontamination", single)
    items = defaultdict(set)
    for _, t in given(spark, "benchmark", "item_id", "text"):
        for w in windows(t)[1]:
            items[len(w)].add(w)
    hit = {i for i, t in pairs(single) for n, known in items.items() for p in range(len(windows(t)[0]) - n + 1) if tuple(windows(t)[0][p : p + n]) in known}
    assert {i for i, _ in pairs(clean)} == {i for i, _ in pairs(single)} - hit
    packed = [r.asDict() for r in run("best_fit_packing", clean).collect()]
    check_packing(packed, pairs(clean))
    digest = lambda rows: sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert digest(r.asDict() for r in corpus_pipeline.run(spark, SF_SMALL).collect()) == digest(packed)

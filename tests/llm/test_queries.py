"""Registered corpus queries on the smallest tables: against SQL, or against plain Python versions."""

import hashlib
import re
import zlib
from collections import defaultdict

import public_tokenizers
import pytest

import corpus_pipeline
from tallymark.llm import secrets, tokens
from tallymark.llm.queries import ORACLES, QUERIES
from tests.llm import brute
from tests.oracle import compare


@pytest.fixture(scope="module")
def texts(spark, data):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, data, duck):
    state, detail = compare(QUERIES[name](spark, data), duck, ORACLES[name])
    assert state == "exact", detail


def test_every_operator_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    numbers = {int(n[2:].split("_")[0]) for n in QUERIES}
    assert numbers == set(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_sharding_query(spark, data, texts):
    rows = QUERIES["op1_sharding"](spark, data).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {k: (len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in texts.items()}
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 16)
    assert set(slots) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_token_count_query(spark, data, texts):
    library = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"), True)
    for r in QUERIES["op2_token_counts"](spark, data).collect():
        n = len(library.whole(texts[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 1024)


def test_quality_query(spark, data, texts):
    rows = QUERIES["op3_quality_rules"](spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute.base_measures(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    good = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert sum(good) >= 0.99 * len(good)


def test_secret_query(spark, data, texts):
    for r in QUERIES["op4_secret_scan"](spark, data).collect():
        base = [f"{k}:{s}:{e}" for k, s, e in brute.base_secrets(texts[r["doc_id"]])]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r["spans"].split(",")) | {""}


def test_extraction_query(spark, data):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    import html

    for r in QUERIES["op5_html_extraction"](spark, data).collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", pages[r["page_id"]], re.S)
        found = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inside[1] if inside else "")]
        assert r["text"] == "\n".join(b for b in found if b) and r["n_chars"] == len(r["text"])


def check_packing(rows, texts):
    library, made, by = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"), False), defaultdict(list), defaultdict(list)
    for r in rows:
        made[r["doc_id"]].append(r)
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(made) == set(texts)
    for key, text in texts.items():
        ids = [*library.whole(text or ""), 0]
        want = [(i, 2048 * i, ids[2048 * i : 2048 * i + 2048]) for i in range(-(-len(ids) // 2048))]
        got = [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in sorted(made[key], key=lambda r: r["piece"])]
        assert got == [(i, s, len(p), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in p))) for i, s, p in want]
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= -(-sum(r["length"] for r in rows) // 2048) + 2


def test_packing_query(spark, data, texts):
    check_packing(QUERIES["op6_best_fit_packing"](spark, data).collect(), texts)


def test_near_duplicate_query(spark, data, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op7_minmax_near_dedup"](spark, data).collect()}
    assert got == brute.near_duplicates(list(texts.items()))


def test_pipeline_stage_by_stage(spark, data, texts):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, n = docs.columns, 0
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = corpus_pipeline.written(stage(spark, docs, data))
        n += 1
        if n == 5:
            check_packing(docs.collect(), before)
            break
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        if n == 1:
            assert all(not brute.base_measures(t)["base_failed"] for t in after.values()) and 0 < len(after) < len(before)
        if n == 2:
            assert set(after) == {k for k, (_, c) in brute.near_duplicates(list(before.items())).items() if k == c}
        if n == 3:
            assert set(after) == {k for k, v in brute.decontamination(list(before.items()), items).items() if not v[1]}
        if n == 4:
            assert set(after) == set(before) and not any(secrets.base_spans(t) for t in after.values())
            assert all(after[k] == t for k, t in before.items() if not brute.base_secrets(t))
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        else:
            assert all(before[k] == t for k, t in after.items())


def test_pipeline_of_nothing_and_extra_columns(spark, data, tmp_path):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{data}/documents.parquet")
    for rows in (docs.limit(0), docs.limit(40).withColumns({"n_words": F.lit("clash"), "kept": F.lit(1), "spans": F.lit(2), "__x": F.lit(3)})):
        out = rows
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = corpus_pipeline.written(stage(spark, out, data))
            assert out.columns == rows.columns
        corpus_pipeline.STAGES[4][1](spark, out, data).collect()

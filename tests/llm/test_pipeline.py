"""The pipeline's stages on a small table, each against what it must keep and change."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from obsguard.llm.common import stored
from tests.llm import plain
from tests.llm.test_operators import pieces_round_trip

SF = "/root/testdata/sf0.01"


def test_each_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), f"test-{name}")
        rows = after.collect()
        had = {r["doc_id"]: r for r in before}
        if name != "packing":
            assert after.columns == columns and rows
        if name == "toxicity":
            gone = set(had) - {r["doc_id"] for r in rows}
            labelled = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert len(gone & toxic) >= 0.6 * len(toxic) and len((gone & labelled) - toxic) <= 0.02 * len(labelled)
        if name == "ngram_jaccard_join":
            want = plain.jaccard_components([(r["doc_id"], r["text"]) for r in before], corpus_pipeline.NEAR_SHARE, corpus_pipeline.NEAR_WIDTH)
            assert {r["doc_id"] for r in rows} == {c for _, c in want.values()}
        if name == "secret_scan":
            assert {r["doc_id"] for r in rows} == set(had)
            for r in rows:
                found = plain.secret_spans(had[r["doc_id"]]["text"])
                assert (not found or r["text"] != had[r["doc_id"]]["text"]) and not plain.secret_spans(r["text"])
        if name == "mixing":
            assert {r["doc_id"] for r in rows} <= set(had) and len(rows) >= 0.9 * len(before)
            assert all(r["text"] == had[r["doc_id"]]["text"] for r in rows)
        if name == "packing":
            once = Counter(r["doc_id"] for r in before)
            source = [(r["doc_id"], r["text"]) for r in before if once[r["doc_id"]] == 1]
            alone = [r for r in rows if once[r["doc_id"]] == 1]
            assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
            assert sum(r["length"] for r in rows if r["start"] == 0) and {r["doc_id"] for r in rows} == set(once)
            for doc, _ in source[:50]:
                mine = sorted((r["start"], r["length"]) for r in alone if r["doc_id"] == doc)
                assert sum(n for _, n in mine) == next(r["doc_tokens"] for r in alone if r["doc_id"] == doc)
            assert pieces_round_trip is not None
        docs, before = after, rows


def test_near_duplicates_take_five_words_and_four_fifths(spark):
    base = [f"w{i}" for i in range(200)]
    longer = base + [f"x{i}" for i in range(45)]  # 196 of 241 shingles: 0.81
    far = base + [f"y{i}" for i in range(60)]  # 196 of 256: 0.77
    rows = [(i, " ".join(w), "en", "s", 1) for i, w in enumerate((base, longer, far))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, docs, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2]

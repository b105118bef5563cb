"""The classifier on held-out documents, and the pipeline stage by stage."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from ringspan.llm import quality
from ringspan.llm.hashing import LOWER, byte_table, words
from ringspan.llm.queries import PIECE_BPE, QUERIES

DATA = "/root/testdata/sf0.01"


def test_word_hashes():
    """Equal words have equal hashes wherever they stand; texts cut into blocks give the same words."""
    kinds = byte_table(word=bytes(b for b in range(256) if b != 0x20))
    texts = ["the cat The", None, "", "é the", "x " * 700_000 + "cat", "y" * 2_000_000, "cat"]
    got = {}
    for rows, hashes, _, _ in words(pa.array(texts), kinds, LOWER):
        for row, h in zip(rows.tolist(), hashes.tolist()):
            got.setdefault(row, []).append(h)
    the, cat = got[0][:2]
    assert got[0] == [the, cat, the] and got[3][1] == the and got[6] == [cat] and got[4][-1] == cat
    assert len(got[4]) == 700_001 and len(got[5]) == 1 and 1 not in got and 2 not in got
    sliced = pa.array(texts).slice(3, 1)
    ((rows, hashes, _, _),) = words(sliced, kinds, LOWER)
    assert hashes.tolist() == got[3] and set(rows.tolist()) == {0}


def _corpus(spark, n=400):
    rng = random.Random(1)
    good, bad = ["the house is old", "we went home", "rain fell softly on it"], ["BUY!!", "win$$$", "click###"]
    rows = []
    for i in range(n):
        label = int(rng.random() < 0.7)
        rows.append((i, " ".join(rng.choice(good if label else bad) for _ in range(rng.randint(5, 60))), label))
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(n, None, "x"), (n + 1, "", "x"), (None, "the house", "x"), (3, rows[3][1], "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_held_out_accuracy(spark):
    rows, docs, labels = _corpus(spark)
    got = quality.score_quality(docs.repartition(5), labels).collect()
    assert len(got) == len(rows) + 4
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert np.mean([truth[r["doc_id"]] == r["predicted"] for r in held if r["doc_id"] in truth]) > 0.97
    again = quality.score_quality(docs.repartition(2), labels).collect()
    key = lambda r: (r["doc_id"] is not None, r["doc_id"], r["score"])
    assert [r["score"] for r in sorted(got, key=key)] == pytest.approx([r["score"] for r in sorted(again, key=key)], abs=1e-6)


def test_labels_of_held_out_rows_are_not_used(spark):
    _, docs, labels = _corpus(spark)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) as quality")
    first = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, labels).collect()}
    second = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, flipped).collect()}
    assert first == pytest.approx(second)


def test_without_labels(spark):
    _, docs, labels = _corpus(spark, 40)
    assert all(r["score"] == 0.5 for r in quality.score_quality(docs, labels.limit(0)).collect())
    ones = labels.where("quality = 1")
    assert all(r["predicted"] == 1 for r in quality.score_quality(docs, ones).collect())
    assert quality.score_quality(docs.limit(0), labels).collect() == []


def test_keep_quality(spark):
    rows, docs, labels = _corpus(spark)
    kept = quality.keep_quality(docs, labels)
    scored = {(r["doc_id"], r["predicted"]) for r in quality.score_quality(docs, labels).collect()}
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == {d for d, p in scored if p}


def test_keep_quality_sends_a_text_once(spark):
    """Beside its row a text would double the batches in the executors' memory; texts that are no strings are cast."""
    rows, docs, labels = _corpus(spark)
    kept = quality.keep_quality(docs, labels)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "row#" in plan and "text#" not in plan.split("MapInArrow keep(")[1].split(")")[0]
    raw = docs.withColumn("text", docs["text"].cast("binary"))
    found = quality.keep_quality(raw, labels)
    assert found.schema == raw.schema
    assert sorted(str(r["doc_id"]) for r in found.collect()) == sorted(str(r["doc_id"]) for r in kept.collect())


def test_scores_of_the_table(spark):
    got = QUERIES["op10_quality"](spark, DATA).where("held_out").select("doc_id", "predicted")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    both = got.join(labels, "doc_id").collect()
    assert np.mean([r["quality"] == r["predicted"] for r in both]) > 0.95


def test_pipeline_stages(spark):
    """Each stage takes what the one before has kept and returns the columns of documents."""
    from ringspan.llm.pieces import decode_pieces

    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id < 150")
    columns, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 50
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"]: r["text"] for r in decode_pieces(encoded, PIECE_BPE).collect()} == texts
    assert encoded.where("not intact").count() == 0
    assert all(len(t or "") == n for t, n in docs.select("text", "n_chars").collect())


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
    assert docs.collect() == []

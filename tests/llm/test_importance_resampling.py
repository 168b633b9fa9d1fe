"""Resampling against plain loops."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from corpusmill.llm import importance_resampling as ir
from corpusmill.llm.queries import op12_importance_resampling

DIR = "/root/testdata/sf0.001"


def features(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature, buckets=10_000):
    return zlib.crc32(feature.encode()) % buckets


def by_loops(docs, target, percent=25, min_words=20):
    """doc_id -> (n_features, weight, score, rank) for ids that are unique and not null."""
    s, t = (Counter(bucket(f) for text in rows for f in features(text)[1]) for rows in ([text for _, text in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)}
    out, fit = {}, []
    for doc_id, text in docs:
        words, grams = features(text)
        weight = sum(gain[bucket(f)] for f in grams) // len(grams) if grams else 0
        h = int(hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()[:8], 16)
        out[doc_id] = [len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
        if len(words) >= min_words:
            fit.append((-out[doc_id][2], doc_id))
    for rank, (_, doc_id) in enumerate(sorted(fit)[: percent * len(fit) // 100], 1):
        out[doc_id][3] = rank
    return {k: tuple(v) for k, v in out.items()}


def test_the_query_is_the_loops(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    out = op12_importance_resampling(spark, DIR)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in out.dtypes} == {"bigint"}
    assert {r.doc_id: tuple(r)[1:] for r in out.collect()} == by_loops(docs, target)


def test_odd_rows(spark):
    random.seed(2)
    texts = [" ".join(random.choice(["A1", "b", "Ünï", "d-e", "x" * 30]) for _ in range(random.choice([5, 19, 20, 60]))) for _ in range(60)]
    texts += [None, "", " .,- ", "one", "É é", "word " * 40_000, "a b " * 10]
    docs = list(enumerate(texts))
    table = spark.createDataFrame([(k, t, "x", 1) for k, t in docs] + [(None, texts[0], "y", 2)], "doc_id long, text string, rank string, bucket int").repartition(3)
    target = spark.createDataFrame([(k, t) for k, t in enumerate(["b b b", None, "", "a1 ünï"])], "item_id long, text string")
    rows = ir.resample(table, target, percent=50).collect()
    want = by_loops([*docs, (-1, texts[0])], ["b b b", None, "", "a1 ünï"])
    kept = [r for r in rows if r.doc_id is not None]
    assert len(rows) == len(docs) + 1 and {r.doc_id: (r.n_features, r.weight, r.score) for r in kept} == {k: v[:3] for k, v in want.items() if k >= 0}
    fit = sorted((-r.score, r.doc_id) for r in kept if len(features(texts[r.doc_id])[0]) >= 20)
    assert {r.doc_id: r.rank for r in kept if r.rank} == {d: k for k, (_, d) in enumerate(fit[: len(fit) // 2], 1)}
    alone = [r for r in rows if r.doc_id is None]
    assert [(r.score, r.rank) for r in alone] == [(None, None)]


def test_repeated_rows_have_ranks_of_their_own(spark):
    table = spark.createDataFrame([(5, "w " * 30)] * 7 + [(9, "v " * 30)], "doc_id long, text string")
    out = ir.resample(table, table.where("false").select("text"), percent=100).collect()
    assert sorted(r.rank for r in out) == list(range(1, 9))
    assert ir.resample(table.where("false"), table).collect() == []


def test_interned_features_are_told_apart_by_their_bytes(monkeypatch):
    """With keys that collide all the time every n-gram still has a slot of its own."""
    monkeypatch.setattr(ir.xxhash, "xxh64_intdigest", lambda gram: len(gram) % 3)
    texts = ["ab cd ef", "cd ab x" * 3, None, "ef " + "long" * 9 + "a " + "long" * 9 + "b"]
    table = ir.Interned([(t or "").encode() for t in texts])
    count = Counter(bucket(f) for t in texts for f in features(t)[1])
    assert table.by_bucket().tolist() == [count[b] for b in range(10_000)]
    gains = np.arange(10_000) - 5000
    assert table.sums(gains).tolist() == [sum(bucket(f) - 5000 for f in features(t)[1]) for t in texts]


@pytest.mark.parametrize("partitions", [1, 6])
def test_ranks_along_ranges(spark, partitions):
    rows = spark.range(500).selectExpr("id % 7 as score", "id").repartition(partitions)
    out = ir.ranked(rows, [ir.F.desc("score"), "id"], "rank").collect()
    want = sorted(((-(k % 7), k) for k in range(500)))
    assert {r.id: r["rank"] for r in out} == {k: n for n, (_, k) in enumerate(want, 1)}


@pytest.mark.parametrize("words", [1, 2, 3])
def test_long_texts_in_pieces(monkeypatch, words):
    """Pieces that end anywhere between words have the n-grams of the whole, those across their ends included."""
    random.seed(words)
    monkeypatch.setattr(ir, "TOGETHER", 23)
    texts = [" ".join(random.choice(["Ab", "c", "-", "Ünï", "x" * 60, ".,", "9"]) for _ in range(random.choice([0, 1, 5, 80]))) for _ in range(40)] + [None, "   ", "q" * 100]
    total, sums, n, n_words = np.zeros(10_000, np.int64), *(np.zeros(len(texts), np.int64) for _ in range(3))
    gains = np.arange(10_000) - 5000
    for run, carried, owner in ir._together(texts, words):
        table = ir.Interned(run, words, 10_000, carried)
        total += table.by_bucket()
        for all_, found in ((sums, table.sums(gains)), (n, table.per_text), (n_words, table.n_words)):
            np.add.at(all_, owner, found)
    count = Counter()
    for i, text in enumerate(texts):
        w = features(text)[0]
        grams = [" ".join(w[k : k + m]) for m in range(1, words + 1) for k in range(len(w) - m + 1)]
        count.update(bucket(g) for g in grams)
        assert (n_words[i], n[i], sums[i]) == (len(w), len(grams), sum(bucket(g) - 5000 for g in grams)), text
    assert total.tolist() == [count[b] for b in range(10_000)]

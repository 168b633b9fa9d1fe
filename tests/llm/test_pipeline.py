import hashlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from corpusmill.llm import langid_bloom, simhash_pivots
from tests.llm.test_dedup import deduped_by_loops, groups_of, plain_fingerprint, windows_by_loops

DIR = "/root/testdata/sf0.001"


def test_stages_like_loops(spark):
    """Each stage on what the one before it kept, against a version without Spark."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    known = corpus_pipeline.language_id(spark, docs, DIR)
    filters = langid_bloom.fit(docs)
    rows = {r.doc_id: r.text for r in docs.collect()}
    wanted = {i: t for i, t in rows.items() if filters.decide(t)[1] >= corpus_pipeline.MIN_LANGUAGE_SCORE}
    assert {r.doc_id: r.text for r in known.collect()} == wanted and known.columns == docs.columns

    lines = corpus_pipeline.line_dedup(spark, known, DIR)
    wanted = {i: t for i, t in deduped_by_loops(list(wanted.items())).items() if t.strip()}
    assert {r.doc_id: r.text for r in lines.collect()} == wanted and lines.columns == docs.columns

    near = corpus_pipeline.near_dedup(spark, lines, DIR)
    prints = {i: plain_fingerprint(t) for i, t in wanted.items()}
    ids = sorted(prints)
    group = groups_of(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= simhash_pivots.MAX_DISTANCE])
    wanted = {i: t for i, t in wanted.items() if group[i] == i}
    assert {r.doc_id: r.text for r in near.collect()} == wanted and near.columns == docs.columns

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    clean = corpus_pipeline.decontaminate(spark, near, DIR)
    before = windows_by_loops(list(wanted.items()), items)
    kept = {r.doc_id: r.text for r in clean.collect()}
    assert clean.columns == docs.columns
    assert {i for i, x in before.items() if x[1] <= 0.5 * x[0]} >= set(kept) >= {i for i, x in before.items() if not x[1]}
    assert all(not x[4] for x in windows_by_loops(list(kept.items()), items).values())
    assert all(kept[i] == wanted[i] for i, x in before.items() if not x[1])

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in corpus_pipeline.bpe_round_trip(spark, clean, DIR).collect():
        ids = library.encode(kept[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert {r.doc_id for r in corpus_pipeline.run(spark, DIR).select("doc_id").collect()} == set(kept)


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "x", "en", "s", 1)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("id", F.lit("clash"))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, odd, DIR).collect()
        assert stage(spark, odd.where("false"), DIR).count() == 0, name

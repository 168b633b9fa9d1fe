import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusmill.functions.models import BatchModel
from corpusmill.operators import answering, mmr, profile, reports, search, store as stores
from corpusmill.functions.numbering import numbered


def context_by_loop(texts, limit):
    parts, total, cut = [], 0, False
    for t in texts:
        if total + len(t) > limit:
            if limit - total > 200:
                parts.append(t[: limit - total] + answering.CUT_SUFFIX)
            cut = True
            break
        parts.append(t)
        total += len(t)
    return "\n\n".join(parts), len(parts), cut


@pytest.mark.parametrize("lengths", [[300, 500], [800, 300], [799, 300], [801, 300], [1000, 1], [1001], [1300, 0, 5], [0, 0], [1000, 0, 0], [400, 900, 100]])
def test_context(spark, lengths):
    texts = [chr(97 + k) * n for k, n in enumerate(lengths)]
    hits = spark.createDataFrame([(1, k, t) for k, t in enumerate(texts)], "question_id long, rank int, text string")
    row = answering.build_context(hits, 1000).first()
    assert (row.context, row.n_used, row.truncated) == context_by_loop(texts, 1000)


def test_mmr_like_a_plain_loop():
    random = np.random.default_rng(0)
    q, v = random.normal(size=8), random.normal(size=(20, 8))

    def cos(a, b):
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b)

    picked = [max(range(20), key=lambda k: cos(q, v[k]))]
    while len(picked) < 7:
        rest = [k for k in range(20) if k not in picked]
        picked.append(max(rest, key=lambda k: 0.5 * cos(q, v[k]) - 0.5 * max(cos(v[k], v[p]) for p in picked)))
    assert mmr.mmr_order(q, v, 7, 0.5) == picked
    assert len(mmr.mmr_order(q, v[:3], 7, 0.5)) == 3


def test_search_edges(spark):
    rows = spark.createDataFrame([(k, [float(k), 0.0], "same" if k < 2 else str(k)) for k in range(4)] + [(9, None, "none")], "chunk_id long, embedding array<float>, text string")
    asked = spark.createDataFrame([(7, [0.0, 0.0]), (8, None)], "query_id long, embedding array<float>")
    found = search.similarity_search(rows, asked, 10).orderBy("rank").collect()
    assert [(r.query_id, r.chunk_id, r.distance) for r in found] == [(7, k, float(k * k)) for k in range(4)]
    assert search.similarity_search(rows, asked.where("false"), 3).count() == 0
    assert search.similarity_search(rows.where("false"), asked, 3).count() == 0
    one = search.similarity_join(rows, asked.unionByName(spark.createDataFrame([(5, [3.0, 0.0])], asked.schema)), 1).collect()
    assert {(r.query_id, r.chunk_id) for r in one if r.distance == 0} == {(7, 0), (5, 3)}
    keyed = rows.withColumn("store_keys", F.array(F.lit("a"), F.lit("b")))
    scope = spark.createDataFrame([(7, "a", 1.0), (7, "b", 0.5), (7, "gone", 1.0)], "query_id long, store_key string, weight double")
    best = search.hybrid_search(keyed, asked, scope, 5).orderBy("rank").collect()
    assert [(r.chunk_id, r.source_store) for r in best] == [(0, "a"), (2, "a"), (3, "a")]
    with pytest.raises(ValueError):
        search.retrieve(rows, asked, "other")


def test_numbers_cross_steps(spark):
    rows = spark.createDataFrame([("a" if k % 3 else None, k) for k in range(200)], "g string, k int")
    out = numbered(rows, ["g"], ["k"], F.floor(F.col("k") / 7), "n", "total").collect()
    for g in ("a", None):
        mine = sorted((r.k, r.n, r.total) for r in out if r.g == g)
        assert [n for _, n, _ in mine] == list(range(len(mine))) and {t for _, _, t in mine} == {len(mine)}


def test_numbers_by_runs_of_steps(spark):
    """Steps of 3 rows, runs of 4 steps: no group, one group with nulls, and a few."""
    rows = spark.createDataFrame([(None if k % 5 == 0 else k % 2, k) for k in range(500)], "g int, k int").repartition(3)
    whole = numbered(rows, [], ["k"], F.floor(F.col("k") / 3), "n", "total", fan=4).collect()
    assert {(r.k, r.n, r.total) for r in whole} == {(k, k, 500) for k in range(500)}
    out = numbered(rows, ["g"], ["k"], F.floor(F.col("k") / 3), "n", fan=4).collect()
    for g in (None, 0, 1):
        assert [r.n for r in sorted((r for r in out if r.g == g), key=lambda r: r.k)] == list(range(sum(1 for r in out if r.g == g)))


@pytest.mark.parametrize("n", [0, 1, 5, 6, 9, 10, 23])
def test_sample(spark, n):
    pages = spark.createDataFrame([("f", k, "t") for k in range(n)], "path string, page_no int, text string")
    step = n // 5
    want = list(range(n)) if n <= 5 else [k * step for k in range(5)]
    assert sorted(r.page_no for r in profile.sample_pages(pages).collect()) == want


def test_profile_and_loaders(spark):
    pages = spark.createDataFrame([("a", 0, None), ("a", 1, " "), ("b", 0, "x" * 3000), ("c", 0, "Table " + "y" * 400)], "path string, page_no int, text string")
    files = spark.createDataFrame([(p,) for p in "abcd"], "path string")
    rows = {r.path: r for r in profile.recommend_loader(profile.profile_files(pages, files)).collect()}
    assert [rows[p].recommended_loader for p in "abcd"] == ["unstructured", "pdfminer", "plumber", "pymupdf"]
    assert rows["d"].n_sampled == 0 and rows["a"].scanned_ratio == 1.0 and rows["a"].has_images
    locked = profile.recommend_loader(profile.profile_files(pages), F.col("path") == "b")
    assert {r.path: r.recommended_loader for r in locked.collect()}["b"] == "unstructured"


def test_first_success(spark):
    tries = [("f", "plumber", False, "p"), ("f", "pypdf", True, None), ("g", "pypdf", False, "x"), ("g", "plumber", False, "y"), ("h", "pymupdf", True, None)]
    attempts = spark.createDataFrame(tries, "path string, loader string, ok boolean, error string")
    wanted = spark.createDataFrame([("f", "plumber"), ("g", "plumber"), ("h", "pymupdf")], "path string, recommended_loader string")
    rows = {r.path: (r.loader_used, r.fallback_used, r.error_log) for r in reports.first_success(attempts, wanted).collect()}
    assert rows == {"f": ("pypdf", True, ["p"]), "g": (None, True, ["y", "x"]), "h": ("pymupdf", False, [])}


def test_models_that_fail_are_skipped(spark):
    def broken(_):
        raise RuntimeError("no key")

    texts = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id int, text string")
    rows, status = stores.embed_with_models(texts, "d", {"md5": F.md5, "broken": broken})
    assert {(r.id, r.store_key, r.vector) for r in rows.collect()} == {(1, "d_md5", "0cc175b9c0f1b6a831c399e269772661"), (2, "d_md5", "0cc175b9c0f1b6a831c399e269772661"), (3, "d_md5", None)}
    assert {(r.model, r.ok) for r in status.collect()} == {("md5", True), ("broken", False)}


def test_models_that_fail_in_a_task_are_skipped(spark):
    def picky(texts):
        if (texts == "b").any():
            raise ValueError("no b")
        return texts.str.upper()

    texts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None), (5, "c")], "id int, text string")
    good = BatchModel(lambda t: t.str.len().astype(str), "string")
    rows, status = stores.embed_with_models(texts, "d", {"picky": BatchModel(picky, "string"), "good": good})
    assert {(r.id, r.store_key, r.vector) for r in rows.collect()} == {(1, "d_good", "1"), (2, "d_good", "1"), (3, "d_good", "1"), (4, "d_good", None), (5, "d_good", "1")}
    assert {(r.model, r.ok, r.error, r.failed) for r in status.collect()} == {("picky", False, "ValueError: no b", 2), ("good", True, None, 0)}
    rows, status = stores.embed_with_models(texts.where("id <> 2 and id <> 3"), "d", {"picky": BatchModel(picky, "string")})
    assert {(r.id, r.vector) for r in rows.collect()} == {(1, "A"), (4, None), (5, "C")} and [r.ok for r in status.collect()] == [True]
    rows, status = stores.embed_with_models(texts.where("false"), "d", {"good": good})
    assert rows.count() == 0 and [r.ok for r in status.collect()] == [True]


def test_each_text_is_embedded_once(spark):
    """Single texts where they stand, repeated ones once, whatever the marks say."""
    seen = spark.sparkContext.accumulator(0)

    def embed(column):
        @F.pandas_udf("string")
        def run(texts: pd.Series) -> pd.Series:
            seen.add(len(texts))
            return texts.str[::-1]

        return run(column)

    rows = [(k, f"t{k % 30}" if k < 90 else f"u{k}") for k in range(200)] + [(900, None), (901, "")]
    out = stores.embed_once(spark.createDataFrame(rows, "id int, text string").repartition(4), embed).collect()
    assert {(r.id, r.vector) for r in out} == {(k, t and t[::-1] if t is not None else None) for k, t in rows} and seen.value == 30 + 110 + 1


def test_compression_keeps_all_if_nothing_is_left(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "c"], ["x", "", None]), (2, ["a"], [""]), (3, ["a", "b"], None)], "i int, c array<string>, e array<string>")
    out = {r.i: r.x for r in rows.select("i", answering.compression(F.col("c"), F.col("e")).alias("x")).collect()}
    assert (out[1].kept, out[1].removed, out[1].ratio) == (["x"], 2, "1/3 (33%)")
    assert (out[2].kept, out[2].removed, out[3].kept) == (["a"], 0, ["a", "b"])

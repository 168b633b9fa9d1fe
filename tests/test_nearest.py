"""Nearest neighbours by both ways against plain distances."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import nearest, search


def by_loop(rows, queries, k):
    """(query, key) -> ids, by exact distances and ids. rows: id, vector, names; queries: id, vector, names."""
    out = {}
    for q, v, keys in queries:
        for key in keys:
            near = sorted((float(((np.array(x) - np.array(v)) ** 2).sum()), i) for i, x, names in rows if key in names)
            if near:
                out[q, key] = [(rank, i) for rank, (_, i) in enumerate(near[:k], 1)]
    return out


def taken(found):
    out = {}
    for r in found.collect():
        out.setdefault((r.query_id, r.store_key), []).append((r["rank"], r.chunk_id))
    return {key: sorted(x) for key, x in out.items()}


def table(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v], names) for i, v, names in rows], "chunk_id long, embedding array<float>, store_keys array<string>")


def vectors(kind, n, random):
    if kind == "clusters":
        return (random.integers(0, 5, (n, 1)) * 10 + random.normal(size=(n, 6))).astype(np.float32)
    if kind == "equal":
        return np.repeat(random.integers(-2, 3, (3, 6)), n // 3 + 1, axis=0)[:n].astype(np.float32)
    return random.normal(size=(n, 6)).astype(np.float32)


@pytest.mark.parametrize("kind", ["clusters", "equal", "noise"])
def test_both_ways_give_the_plain_result(spark, kind, monkeypatch):
    """Small blocks and lists, so that cells are cut, queries visit several blocks and equal vectors stand in many."""
    random = np.random.default_rng(3)
    monkeypatch.setattr(nearest, "ROWS", 50)
    rows = [(i, v, ["a", "b", "c"][i % 3 :][:2]) for i, v in enumerate(vectors(kind, 400, random))]
    queries = [(1000 + i, v, ["a", "c", "gone"][: 1 + i % 3]) for i, v in enumerate(vectors(kind, 40, random))]
    store = table(spark, rows).repartition(3)
    asked = spark.createDataFrame([(q, [float(x) for x in v]) for q, v, _ in queries], "query_id long, embedding array<float>")
    scope = spark.createDataFrame([(q, key) for q, _, keys in queries for key in keys], "query_id long, store_key string")
    plain = by_loop([(i, v, [""]) for i, v, _ in rows], [(q, v, [""]) for q, v, _ in queries], 7)
    scoped = by_loop(rows, queries, 7)
    for limit in (10_000, -1):
        assert taken(nearest.nearest(store, asked, 7, scanned=limit)) == plain
        assert taken(nearest.nearest(store, asked, 7, scope, scanned=limit)) == scoped
    small = nearest.exchanged(store.select("chunk_id", "embedding", F.array(F.lit("")).alias("groups")), asked.withColumn("store_key", F.lit("")), 7, {}, pivots=5, shells=3, block=17)
    best = small.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("distance", "chunk_id"))), 1, 7).alias("x"))
    assert {(r.query_id, ""): [(n, x.chunk_id) for n, x in enumerate(r.x, 1)] for r in best.collect()} == plain


def test_more_than_one_list_length_and_text_ids(spark):
    store = spark.createDataFrame([(f"c{i:02}", [float(i), 1.0], ["x", "y"]) for i in range(30)], "chunk_id string, embedding array<double>, store_keys array<string>")
    asked = spark.createDataFrame([("q", [0.0, 1.0]), ("r", None)], "query_id string, embedding array<double>")
    scope = spark.createDataFrame([("q", "x"), ("q", "y"), ("r", "x")], "query_id string, store_key string")
    for limit in (100, -1):
        found = taken(nearest.nearest(store, asked, 2, scope, k_of={"y": 4}, scanned=limit))
        assert found == {("q", "x"): [(1, "c00"), (2, "c01")], ("q", "y"): [(k + 1, f"c{k:02}") for k in range(4)]}


@pytest.mark.parametrize("limit", [100, -1])
def test_edges(spark, limit):
    rows = spark.createDataFrame([(k, [float(k), 0.0]) for k in range(4)] + [(9, None)], "chunk_id long, embedding array<float>")
    asked = spark.createDataFrame([(7, [0.0, 0.0]), (8, None)], "query_id long, embedding array<float>")
    assert taken(nearest.nearest(rows, asked, 10, scanned=limit)) == {(7, ""): [(k + 1, k) for k in range(4)]}
    for a, b in ((rows.where("false"), asked), (rows, asked.where("false"))):
        assert nearest.nearest(a, b, 3, scanned=limit).count() == 0


def test_far_shells_are_not_visited(spark):
    """Clusters far apart: a query's rows come from its own cluster's blocks, and a task of the scan gives k rows a query."""
    random = np.random.default_rng(5)
    rows = table(spark, [(i, v, [""]) for i, v in enumerate((np.arange(2000) % 8)[:, None] * 1000 + random.normal(size=(2000, 4)))]).repartition(4)
    asked = rows.where("chunk_id % 4 = 0").select(F.col("chunk_id").alias("query_id"), "embedding", F.lit("").alias("store_key"))
    groups = rows.select("chunk_id", "embedding", F.col("store_keys").alias("groups"))
    met = nearest.exchanged(groups, asked, 3, {}, pivots=16, shells=1, block=10_000)
    assert met.count() <= 500 * 3 * 4
    few = asked.limit(6).toArrow()
    assert nearest.scan(groups, few, asked.schema, 3, {}).count() == 4 * 6 * 3


def test_one_scan_of_the_store_for_many_queries(spark, tmp_path):
    random = np.random.default_rng(6)
    path = str(tmp_path / "store")
    table(spark, [(i, v, [""]) for i, v in enumerate(random.normal(size=(3000, 8)))]).write.parquet(path)
    store = spark.read.parquet(path)
    asked = store.select((F.col("chunk_id") + 0).alias("query_id"), "embedding")
    found = search.similarity_join(store, asked.unionByName(asked.withColumn("query_id", -1 - F.col("query_id"))), 1)
    assert found._jdf.queryExecution().executedPlan().toString().count(f"{path}") <= 2  # as queries; the placed rows were written
    rows = found.collect()
    assert len(rows) == 6000 and all(r.distance == 0 and r.chunk_id in (r.query_id, -1 - r.query_id) for r in rows)


def test_filtered_search_widens(spark):
    rows = spark.createDataFrame([(k, [float(k)], k % 10 == 9, "d") for k in range(60)], "chunk_id long, embedding array<double>, good boolean, domain string")
    asked = spark.createDataFrame([(1, [0.0]), (2, [58.5])], "query_id long, embedding array<double>")
    wanted = {"good": True, "domain": ["d"]}
    plain = {(r.query_id, r["rank"]): r.chunk_id for r in search.filtered_search(rows, asked, wanted, 3, 20).collect()}
    assert plain == {(1, 1): 9, (1, 2): 19, (2, 1): 59, (2, 2): 49}
    wide = {(r.query_id, r["rank"]): (r.chunk_id, r.fetched) for r in search.filtered_search(rows, asked, wanted, 3, 20, widen=True).collect()}
    assert wide == {(1, 1): (9, 10), (1, 2): (19, 20), (1, 3): (29, None), (2, 1): (59, 2), (2, 2): (49, 11), (2, 3): (39, None)}
    first = {(r.query_id, r["rank"]): r.chunk_id for r in search.filtered_search(rows, asked, wanted, 3, filter_first=True).collect()}
    assert first == {key: x[0] for key, x in wide.items()}

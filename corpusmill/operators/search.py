"""Exact nearest-neighbour, filtered and weighted search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusmill.functions.text import distance_score
from corpusmill.operators.nearest import nearest


def similarity_search(store: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """K1: query_id, rank (from 1), chunk_id, distance, score of the k nearest, ties by chunk_id.

    A few queries go to all tasks of one scan, each of which gives k rows a query; many are exchanged with the store as in J1.
    """
    return _scored(nearest(store, queries, k))


def similarity_join(store: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """As similarity_search for any number of queries, by blocks of both sides that can hold neighbours; one scan of the store."""
    return _scored(nearest(store, queries, k, scanned=-1))


def _scored(near: DataFrame) -> DataFrame:
    return near.select("query_id", "rank", "chunk_id", "distance", distance_score(F.col("distance")).alias("score"))


def metadata_filter(wanted: dict, lenient: bool = False) -> Column:
    """Every key present and equal to its value, or in its list; lenient lets rows without the key pass."""
    def one(name: str, value) -> Column:
        c = F.col(name)
        match = c.isin(list(value)) if isinstance(value, (list, tuple, set)) else c == F.lit(value)
        return F.coalesce(match, F.lit(lenient)) if lenient else F.coalesce(match, F.lit(False))

    return reduce(Column.__and__, [one(*x) for x in wanted.items()], F.lit(True))


def filtered_search(store: DataFrame, queries: DataFrame, wanted: dict, k: int = 5, fetch_k: int = 20, filter_first: bool = False, widen: bool = False) -> DataFrame:
    """K3: of the fetch_k nearest those that pass the filter, the first k of them; maybe fewer.

    With filter_first the filter comes before the search, and k rows are found where there are so many. With widen a query that
    has fewer than k among its fetch_k nearest goes on to farther rows until it has k or the store ends; `fetched`, the rank
    among all rows, is null for these. One scan of the store keeps the nearest of all rows and the nearest that pass, so
    nothing is read again for it.
    """
    if filter_first:
        return similarity_search(store.where(metadata_filter(wanted)), queries, k)
    named = store.select("chunk_id", "embedding", F.when(metadata_filter(wanted), F.array(F.lit("all"), F.lit("pass"))).otherwise(F.array(F.lit("all"))).alias("names"))
    scope = queries.select("query_id", F.explode(F.array(F.lit("all"), F.lit("pass"))).alias("store_key"))
    near = nearest(named, queries, k, scope, "names", {"all": fetch_k})
    # both are rows of one query and chunk: a chunk that passes and is among the fetch_k nearest has two
    both = near.groupBy("query_id", "chunk_id").agg(F.min("distance").alias("distance"), F.max(F.when(F.col("store_key") == "all", F.col("rank"))).alias("fetched"), F.max(F.when(F.col("store_key") == "pass", F.col("rank"))).alias("rank"))
    passed = both.where(F.col("rank").isNotNull() & (F.lit(widen) | F.col("fetched").isNotNull()))
    return passed.select("query_id", "rank", "chunk_id", "distance", distance_score(F.col("distance")).alias("score"), *(["fetched"] if widen else []))


def first_of_each(hits: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each combination of keys, of groups that are small by design (a query's hits)."""
    return hits.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def first_of_equal_texts(docs: DataFrame, order: str, text: str = "text") -> DataFrame:
    """D2 on a table: the value of `order` of the first row of each text, by partial minima; a text that a third of all rows have is no hot group."""
    return docs.groupBy(F.md5(text)).agg(F.min(order).alias(order)).select(order)


def hybrid_search(store: DataFrame, queries: DataFrame, scope: DataFrame, k: int = 5) -> DataFrame:
    """K2: weighted search over several stores: query_id, rank, chunk_id, score (4 places), source_store.

    store: chunk_id, text, embedding, store_keys (array). scope: query_id, store_key, weight (null: one over the number of the
    query's stores). Each store in the query's scope gives its 3k nearest, rows of other stores aren't compared; of equal texts the
    one with the highest weighted score stays.
    """
    top = nearest(store, queries, 3 * k, scope)
    sized = scope.groupBy("query_id").agg(F.count("*").alias("_n"))
    weighted = scope.join(sized, "query_id").select("query_id", "store_key", F.coalesce("weight", 1 / F.col("_n")).alias("weight"))
    scored = top.join(weighted, ["query_id", "store_key"]).select("query_id", "store_key", "chunk_id", (distance_score(F.col("distance")) * F.col("weight")).alias("score"))
    keyed = scored.join(store.select("chunk_id", F.md5(F.coalesce("text", F.lit(""))).alias("content")), "chunk_id")
    order = [F.desc("score"), F.col("store_key"), F.col("chunk_id")]
    distinct = first_of_each(keyed, ["query_id", "content"], order)
    final = F.row_number().over(W.partitionBy("query_id").orderBy(*order))
    return distinct.withColumn("rank", final).where(F.col("rank") <= k).select("query_id", "rank", "chunk_id", F.round("score", 4).alias("score"), F.col("store_key").alias("source_store"))


def retrieve(store: DataFrame, queries: DataFrame, strategy: str = "similarity", k: int = 5, domain: str | None = None, scope: DataFrame | None = None) -> DataFrame:
    """K5: search by the named strategy over a domain's store; hybrid needs a domain and else falls back to similarity."""
    from corpusmill.operators.mmr import mmr_search

    if strategy not in ("similarity", "mmr", "hybrid"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "hybrid" and domain is not None and scope is not None:
        return hybrid_search(store, queries, scope, k).select("query_id", "rank", "chunk_id", "score")
    rows = store.where(F.col("domain") == domain) if domain is not None else store
    found = mmr_search(rows, queries, k) if strategy == "mmr" else similarity_search(rows, queries, k)
    return found.select("query_id", "rank", "chunk_id", "score")

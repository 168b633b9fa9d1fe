"""The three workloads end to end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.functions.scratch import let_go, written
from corpusmill.operators.answering import build_context, cache_hits, cache_key, cache_misses, citations, render_prompt
from corpusmill.operators.chunks import stamp_metadata
from corpusmill.operators.profile import profile_files, recommend_loader, sample_pages
from corpusmill.operators.routing import routed
from corpusmill.operators.search import hybrid_search
from corpusmill.operators.splitting import split_by_strategy
from corpusmill.operators.store import embed_once


def corpus_to_store(pages: DataFrame, meta: DataFrame, domain: str, embed: Callable[[Column], Column] = F.md5, size: int | None = None, lot: str | None = None) -> DataFrame:
    """Workload A: pages (path, page_no, text) to stamped, numbered and embedded chunks of a store. lot: as for split_by_strategy.

    The strategies and the metadata, a row a file, are written once: where they are known to be small, no text moves to meet them.
    """
    profile = recommend_loader(profile_files(sample_pages(pages), pages))
    strategies = written(routed(profile, pages))
    let_go(pages.sparkSession)
    chunks = stamp_metadata(split_by_strategy(pages, strategies, size, lot), written(meta))
    rows = embed_once(chunks, embed, in_steps=True)
    return rows.withColumn("domain", F.lit(domain)).withColumn("content_type", F.coalesce("content_type", F.lit("general")))


def questions_to_prompts(store: DataFrame, questions: DataFrame, scope: DataFrame, k: int = 5, max_chars: int = 12_000) -> DataFrame:
    """Workload B: query_id, prompt, n_used from questions (query_id, question, question_type, embedding)."""
    hits = hybrid_search(store, questions, scope, k)
    texts = hits.join(store.select("chunk_id", "text"), "chunk_id").select(F.col("query_id").alias("question_id"), "rank", "text")
    contexts = build_context(texts, max_chars).withColumnRenamed("question_id", "query_id")
    joined = questions.select("query_id", "question", "question_type").join(contexts, "query_id", "left")
    return joined.select("query_id", render_prompt(F.col("question_type"), F.col("context"), F.col("question")).alias("prompt"), F.coalesce("n_used", F.lit(0)).alias("n_used"))


def prompts_to_answers(prompts: DataFrame, cache: DataFrame, model: Callable[[Column], Column], sources: DataFrame) -> DataFrame:
    """Workload C: prompt_id, response, cache_hit, citations. The model sees each distinct uncached prompt once.

    sources: prompt_id, docs (array of structs of title and source), or no row.
    """
    known = cache_hits(prompts, cache).withColumn("cache_hit", F.lit(True))
    fresh = cache_misses(prompts, cache).select("key", "model", model(F.col("prompt")).alias("response"))
    keyed = prompts.select("prompt_id", cache_key(F.col("prompt")).alias("key"), "model")
    answered = keyed.join(fresh, ["key", "model"]).select("prompt_id", "response", F.lit(False).alias("cache_hit"))
    cited = sources.select("prompt_id", citations("title", "source", "docs").alias("citations"))
    return known.unionByName(answered).join(cited, "prompt_id", "left")

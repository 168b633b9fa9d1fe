"""From question to prompt and from answers to reports: contexts, histories, citations, caches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusmill.functions.text import percent
from corpusmill.operators.search import first_of_each

CONTEXT_CHARS, CUT_MINIMUM, CUT_SUFFIX = 12_000, 200, "\n[... cut]"
HISTORY_PAIRS = 6
QUESTION_TYPES = ("factual", "summary", "comparison", "procedural")
#: One template for each question type; {context} and {question} are filled in.
TEMPLATES = {
    "factual": "Answer from the context alone, and say so if it holds no answer.\n\nContext:\n{context}\n\nQuestion: {question}\nAnswer:",
    "summary": "Summarise what the context says on the question, in a few points.\n\nContext:\n{context}\n\nQuestion: {question}\nSummary:",
    "comparison": "Compare, point by point, what the context says.\n\nContext:\n{context}\n\nQuestion: {question}\nComparison:",
    "procedural": "List the steps that the context gives, in order.\n\nContext:\n{context}\n\nQuestion: {question}\nSteps:",
}


def question_type(answer: Column) -> Column:
    """A classifier's answer as one of the types; anything else, null too, is factual."""
    name = F.lower(F.btrim(answer, F.lit(" \t\n\r")))
    return F.when(name.isin(*QUESTION_TYPES), name).otherwise("factual")


def render_prompt(kind: Column, context: Column, question: Column) -> Column:
    """P10: the template of a question's type with context and question in place; null ones are empty."""
    template = F.lit(TEMPLATES["factual"])
    for name, text in TEMPLATES.items():
        template = F.when(kind == name, F.lit(text)).otherwise(template)
    # the question goes in first, so that a context that mentions {question} stays as it is
    filled = F.split(template, r"\{context\}", 2)
    tail = F.replace(filled[1], F.lit("{question}"), F.coalesce(question, F.lit("")))
    return F.concat(filled[0], F.coalesce(context, F.lit("")), tail)


def derived_queries(question: Column, model_text: Column) -> Column:
    """the question and the trimmed lines of a model's text that aren't blank, as an array."""
    lines = F.transform(F.split(F.coalesce(model_text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(" \t\r")))
    return F.concat(F.array(question), F.filter(lines, lambda x: x != ""))


def merge_query_hits(hits: DataFrame, k: int = 5) -> DataFrame:
    """Hits of a question's queries in (query_no, rank) order, the first of each text, cut to k.

    hits: question_id, query_no, rank, chunk_id, text. Returns question_id, rank, chunk_id, text.
    """
    keyed = hits.withColumn("_key", F.md5(F.coalesce("text", F.lit(""))))
    order = ["query_no", "rank", "chunk_id"]
    once = first_of_each(keyed, ["question_id", "_key"], order)
    place = F.row_number().over(W.partitionBy("question_id").orderBy(*order))
    return once.withColumn("place", place).where(F.col("place") <= k).select("question_id", F.col("place").alias("rank"), "chunk_id", "text")


def build_context(hits: DataFrame, max_chars: int = CONTEXT_CHARS) -> DataFrame:
    """question_id, context, n_used, truncated from hits (question_id, rank, text) in rank order.

    Whole chunks as long as they fit; the first that doesn't is cut to what is left if that is more than 200 characters,
    with a suffix. Separators don't count. A question has at most k hits, so its group is small; null texts are empty.
    """
    ordered = W.partitionBy("question_id").orderBy("rank")
    text = F.coalesce("text", F.lit(""))
    before = F.coalesce(F.sum(F.length(text)).over(ordered.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    summed = hits.select("question_id", "rank", text.alias("t"), before.alias("before"))
    left = F.lit(max_chars) - F.col("before")
    whole = F.length("t") <= left
    # a chunk after the first overflow has a sum before it that is already beyond the limit
    cut = ~whole & (F.col("before") <= max_chars) & (left > CUT_MINIMUM)
    part = F.when(whole, F.col("t")).when(cut, F.concat(F.substring("t", F.lit(1), left.cast("int")), F.lit(CUT_SUFFIX)))
    # an empty chunk after an overflow would fit, so nothing counts after the first overflow
    over = F.max(F.when(~whole, 1).otherwise(0)).over(ordered.rowsBetween(W.unboundedPreceding, -1))
    kept = summed.withColumn("part", part).withColumn("late", F.coalesce(over, F.lit(0)) == 1)
    used = kept.withColumn("part", F.when(~F.col("late"), F.col("part"))).groupBy("question_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("part").isNotNull(), F.struct("rank", "part")))).alias("p"), F.bool_or(~(F.length("t") <= F.lit(max_chars) - F.col("before"))).alias("truncated")
    )
    return used.select("question_id", F.array_join(F.transform("p", lambda x: x["part"]), "\n\n").alias("context"), F.size("p").cast("long").alias("n_used"), "truncated")


def history(conversations: DataFrame, pairs: int = HISTORY_PAIRS) -> DataFrame:
    """conv_id, turn, history: the messages before each one, the last 2 * pairs of them, as structs of role and text."""
    window = W.partitionBy("conv_id").orderBy("turn").rowsBetween(-2 * pairs, -1)
    return conversations.select("conv_id", "turn", F.collect_list(F.struct("role", "text")).over(window).alias("history"))


def citations(title: str, source: str, docs: str) -> Column:
    """D3: labels of an array of structs: the title or else the source, blank ones dropped, each once in order."""
    labels = F.transform(docs, lambda d: F.when(F.coalesce(d[title], F.lit("")) != "", d[title]).otherwise(F.coalesce(d[source], F.lit(""))))
    return F.array_distinct(F.filter(labels, lambda x: x != ""))


def compression(chunks: Column, extracts: Column) -> Column:
    """struct kept, before, removed, ratio from chunks and their extracts.

    Chunks whose extract is empty or null go; if all would, or there are no extracts at all, every chunk stays.
    """
    pairs = F.arrays_zip(chunks.alias("chunk"), extracts.alias("extract"))
    some = F.transform(F.filter(pairs, lambda p: F.coalesce(p["extract"], F.lit("")) != ""), lambda p: p["extract"])
    kept = F.when(extracts.isNull() | (F.size(some) == 0), chunks).otherwise(some)
    n, m = F.size(kept), F.size(chunks)
    ratio = F.when((m > 0) & (n > 0), F.concat(n.cast("string"), F.lit("/"), m.cast("string"), F.lit(" ("), percent(n, m), F.lit(")")))
    return F.struct(kept.alias("kept"), m.cast("long").alias("before"), F.greatest(m - n, F.lit(0)).cast("long").alias("removed"), ratio.alias("ratio"))


def cache_key(prompt: Column) -> Column:
    return F.sha2(prompt, 256)


def cache_hits(prompts: DataFrame, cache: DataFrame) -> DataFrame:
    """The prompts (prompt_id, prompt, model) that have a cached answer: prompt_id, response. Null prompts never do.

    cache: key (sha-256 of the prompt), model, response; of several entries of a key the least response is taken.
    """
    one = cache.groupBy("key", "model").agg(F.min("response").alias("response"))
    keyed = prompts.select("prompt_id", cache_key(F.col("prompt")).alias("key"), "model")
    return keyed.join(one, ["key", "model"]).select("prompt_id", "response")


def cache_misses(prompts: DataFrame, cache: DataFrame) -> DataFrame:
    """The work list: each distinct (prompt, model) without a cached answer once: key, model, prompt."""
    keyed = prompts.select(cache_key(F.col("prompt")).alias("key"), "model", "prompt").dropDuplicates(["key", "model"])
    return keyed.join(cache.select("key", "model"), ["key", "model"], "left_anti")


def cache_stats(cache: DataFrame) -> DataFrame:
    """Entries, total_chars, avg_chars (no decimals) in one row; zeros for an empty cache."""
    n = F.length("response")
    return cache.agg(F.count("*").alias("entries"), F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("total_chars"), F.coalesce(F.round(F.avg(n), 0), F.lit(0.0)).alias("avg_chars"))


def session_stats(log: DataFrame) -> DataFrame:
    """One row a session: queries, total_elapsed, avg_elapsed (3 places), type_distribution, hits, misses, hit_rate, removed.

    log: session_id, question_type, elapsed_sec, cache_hit, docs_before, docs_after. Sums by session and type come first, so
    a long session is many partial sums; null cache_hit is a miss.
    """
    gone = F.when(F.coalesce("docs_before", F.lit(0)) > 0, F.greatest(F.col("docs_before") - F.coalesce("docs_after", F.lit(0)), F.lit(0))).otherwise(0)
    hit = F.coalesce("cache_hit", F.lit(False))
    by_type = log.groupBy("session_id", "question_type").agg(F.count("*").alias("n"), F.sum("elapsed_sec").alias("s"), F.count_if(hit).alias("h"), F.sum(gone).alias("g"))
    return by_type.groupBy("session_id").agg(
        F.sum("n").alias("queries"), F.round(F.sum("s"), 3).alias("total_elapsed"), F.round(F.sum("s") / F.sum("n"), 3).alias("avg_elapsed"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("question_type", "n")))).alias("type_distribution"),
        F.sum("h").alias("hits"), (F.sum("n") - F.sum("h")).alias("misses"), percent(F.sum("h"), F.sum("n")).alias("hit_rate"), F.sum("g").cast("long").alias("removed"),
    )

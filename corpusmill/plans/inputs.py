"""The driver's tables in the shapes that the operators take, in DataFrame and in SQL form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusmill.functions.numbering import numbered


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_pages(spark: SparkSession, sf_dir: str, lot: str | None = None) -> DataFrame:
    """Documents as pages: a source is a file, page numbers go by doc_id: doc_id, path, page_no, text, and the lot if it is named."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("path"), "text")
    return numbered(docs, ["path"], ["doc_id"], F.floor(F.col("doc_id") / 10_000), "page_no", lot=lot)


PAGES = "pg AS (SELECT doc_id, source AS path, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS page_no, text FROM documents)"


def decorated_text() -> Column:
    """Sections, a table, a code fence or Korean sentences around a document's text, by doc_id."""
    n, t = F.col("doc_id").cast("string"), F.col("text")
    return (
        F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("# Title "), n, F.lit("\n"), t, F.lit("\n1.1 Part\n"), t))
        .when(F.col("doc_id") % 4 == 1, F.concat(t, F.lit("\n| name | n |\n| --- | --- |\n| a | "), n, F.lit(" |\n| b | 2 |\n"), t))
        .when(F.col("doc_id") % 4 == 2, F.concat(t, F.lit("\n```\nrun "), n, F.lit("\nend\n```\n"), t))
        .otherwise(F.concat(F.repeat(F.lit("한국어 문장입니다. "), 20), t))
    )


def decorated_pages(spark: SparkSession, sf_dir: str, lot: str | None = None) -> DataFrame:
    """Documents with decorated texts; a file is a source and a kind of decoration: doc_id, path, page_no, text, and the lot if it is named.

    Texts are decorated once they have been numbered, as they are shorter before.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat("source", F.lit("#"), (F.col("doc_id") % 4).cast("string")).alias("path"), "text")
    pages = numbered(docs, ["path"], ["doc_id"], F.floor(F.col("doc_id") / 10_000), "page_no", lot=lot)
    return pages.withColumn("text", decorated_text()).select("doc_id", "path", "text", "page_no", *([lot] if lot else []))


DECORATED = r"""dp AS (
  SELECT doc_id, path, row_number() OVER (PARTITION BY path ORDER BY doc_id) - 1 AS page_no, text FROM (
    SELECT doc_id, source || '#' || (doc_id % 4) AS path, CASE doc_id % 4
      WHEN 0 THEN '# Title ' || doc_id || chr(10) || text || chr(10) || '1.1 Part' || chr(10) || text
      WHEN 1 THEN text || chr(10) || '| name | n |' || chr(10) || '| --- | --- |' || chr(10) || '| a | ' || doc_id || ' |' || chr(10) || '| b | 2 |' || chr(10) || text
      WHEN 2 THEN text || chr(10) || '```' || chr(10) || 'run ' || doc_id || chr(10) || 'end' || chr(10) || '```' || chr(10) || text
      ELSE repeat('한국어 문장입니다. ', 20) || text END AS text
    FROM documents))"""

#: SQL's list of the white space that the tables hold.
SPACES = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as a store: chunk_id, domain, content_type (null for label 0), label, text, embedding."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), F.concat(F.lit("d"), (F.col("vec_id") % 3).cast("string")).alias("domain"),
        F.when(F.col("label") != 0, F.concat(F.lit("t"), F.col("label").cast("string"))).alias("content_type"), "label", "embedding",
    )
    return rows.join(docs, "chunk_id", "left")


STORE = "st AS (SELECT vec_id AS chunk_id, 'd' || (vec_id % 3) AS domain, CASE WHEN label <> 0 THEN 't' || label END AS content_type, label, CAST(embedding AS DOUBLE[]) AS e, d.text FROM embeddings LEFT JOIN documents d ON d.doc_id = vec_id)"


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row whose id is divisible by 100 as a query: query_id, embedding."""
    return table(spark, sf_dir, "embeddings").where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


NEAR = "near AS (SELECT q.vec_id AS query_id, st.*, pow(list_distance(CAST(q.embedding AS DOUBLE[]), st.e), 2) AS distance FROM embeddings q, st WHERE q.vec_id % 100 = 0)"


def session_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a question log: ts, session_id, question_type, elapsed_sec, cache_hit, docs_before, docs_after."""
    return table(spark, sf_dir, "events").select(
        "ts", F.col("user_id").alias("session_id"), F.col("event_type").alias("question_type"), F.col("value").alias("elapsed_sec"), (F.col("event_id") % 3 == 0).alias("cache_hit"),
        (F.col("event_id") % 7).alias("docs_before"), (F.col("event_id") % 5).alias("docs_after"),
    )


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of users as prompts: prompt_id, prompt, model."""
    users = table(spark, sf_dir, "conversations").where("role = 'user'")
    return users.select((F.col("conv_id") * 1000 + F.col("turn")).alias("prompt_id"), F.col("text").alias("prompt"), F.concat(F.lit("m"), (F.col("conv_id") % 2).cast("string")).alias("model"))


def answer_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers to a third of the conversations: key, model, response."""
    known = table(spark, sf_dir, "conversations").where("role = 'user' and conv_id % 3 = 0")
    return known.select(F.sha2("text", 256).alias("key"), F.lit("m0").alias("model"), F.reverse("text").alias("response"))


PROMPTS = """pr AS (SELECT conv_id * 1000 + turn AS prompt_id, text AS prompt, 'm' || (conv_id % 2) AS model FROM conversations WHERE role = 'user'),
ca AS (SELECT sha256(text) AS key, 'm0' AS model, reverse(text) AS response FROM conversations WHERE role = 'user' AND conv_id % 3 = 0)"""


def file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a source: path, title, author, page_count, file_size_kb."""
    sums = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("path")).agg(F.count("*").alias("page_count"), F.round(F.sum("n_chars") / 1024, 2).alias("file_size_kb"))
    return sums.where("path <> 'src3'").select("path", F.concat(F.lit("Title of "), F.col("path")).alias("title"), F.when(F.col("page_count") % 2 == 0, "Ann").alias("author"), "page_count", "file_size_kb")


META = "me AS (SELECT source AS path, 'Title of ' || source AS title, CASE WHEN count(*) % 2 = 0 THEN 'Ann' END AS author, count(*) AS page_count, round(sum(n_chars) / 1024, 2) AS file_size_kb FROM documents WHERE source <> 'src3' GROUP BY source)"
